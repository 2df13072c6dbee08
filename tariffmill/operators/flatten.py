"""Nested product items as rows, item look-up, distinct items, and the joined catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill.functions.text import collapse_whitespace


def _items(products: DataFrame, items: str, key: str, fields: dict[str, Column]) -> DataFrame:
    """One row per item.

    For a plain explode Spark adds a filter on the size of the array, and so computes items that are not
    stored yet twice; the outer form has no such filter.
    """
    exploded = products.select(key, F.posexplode_outer(items).alias("pos", "item")).where("pos IS NOT NULL")
    return exploded.select(key, "pos", *[value.alias(name) for name, value in fields.items()])


def _field(name: str) -> Column:
    return F.col(f"item.{name}")


def flatten_taxation(products: DataFrame, items: str = "taxation.taxes", key: str = "hs10") -> DataFrame:
    return _items(products, items, key, {n: _field(n) for n in ("code", "label", "raw")})


def flatten_documents(products: DataFrame, items: str = "documents.documents", key: str = "hs10") -> DataFrame:
    return _items(products, items, key, {n: _field(n) for n in ("code", "name", "issuer", "raw")})


def flatten_agreements(
    products: DataFrame, items: str = "agreements.accord_convention", key: str = "hs10"
) -> DataFrame:
    fields = {
        "country": _field("country"),
        "liste": F.coalesce(_field("list"), F.lit("")),
        "di": F.coalesce(_field("DI"), F.lit("0%")),
        "tpi": F.coalesce(_field("TPI"), F.lit("0%")),
        "raw": _field("raw"),
    }
    return _items(products, items, key, fields)


def flatten_history(
    products: DataFrame, items: str = "import_duty_history.items", key: str = "hs10"
) -> DataFrame:
    """Items with a date: the column allows no others, which :func:`undated_history` reports."""
    fields = {"date": _field("date").cast("date"), "raw": _field("raw")}
    return _items(products, items, key, fields).where("date IS NOT NULL")


def undated_history(products: DataFrame, items: str = "import_duty_history.items", key: str = "hs10") -> DataFrame:
    """Duty history items that have no date, and so no place in the history table."""
    fields = {"date": _field("date").cast("date"), "raw": _field("raw")}
    return _items(products, items, key, fields).where("date IS NULL").drop("date")


def build_rag_chunks(products: DataFrame, topics: dict[str, Column], key: str = "hs10") -> DataFrame:
    """Text chunks per product: their place, topic, text, and the hash of the text with white space collapsed.

    Blank texts give no chunk. A hash occurs once: the chunk of the smallest key and place keeps it.
    """
    made = F.array(*[F.struct(F.lit(topic).alias("topic"), text.alias("text")) for topic, text in topics.items()])
    held = F.filter(made, lambda c: F.coalesce(F.trim(c["text"]), F.lit("")) != "")
    chunks = products.select(key, F.posexplode(held).alias("chunk_index", "chunk")).select(
        key, "chunk_index", F.col("chunk.topic").alias("topic"), F.col("chunk.text").alias("chunk_text")
    )
    hashed = chunks.withColumn("chunk_hash", F.sha2(collapse_whitespace(F.col("chunk_text")), 256))
    first = F.min(F.struct(key, "chunk_index", "topic", "chunk_text")).alias("first")
    return hashed.groupBy("chunk_hash").agg(first).select("first.*", "chunk_hash")


def containing_item(products: DataFrame, items: str, wanted: dict[str, str]) -> DataFrame:
    """Products with an item in which all the wanted fields have the wanted values.

    Spark moves a plain filter on items that are not stored yet down to the scan, where few tasks compute them, and once more
    per use; it does not move a test that is exploded.
    """

    def matches(item: Column) -> Column:
        test = F.lit(True)
        for field, value in wanted.items():
            test = test & (item[field] == value)
        return test

    tested = products.select("*", F.explode_outer(F.array(F.exists(F.col(items), matches))).alias("_contains"))
    return tested.where("_contains").drop("_contains")


def dedupe_items(items: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """First row of each key set over rows that come exploded; combined before the shuffle."""
    return items.groupBy(*keys).agg(F.min(F.struct(*position)).alias("first"))


def catalogue_denormalize(
    products: DataFrame, hs6: DataFrame, hs4: DataFrame, chapters: DataFrame, sections: DataFrame
) -> DataFrame:
    """Products with all labels of the hierarchy taken from the node tables.

    The four node tables are joined to each other first: products meet one table, once.
    """
    path = (
        hs6.select(F.col("id").alias("hs6_id"), "hs4_id", "hs6", F.col("label").alias("hs6_label"))
        .join(hs4.select(F.col("id").alias("hs4_id"), "chapter_id", "hs4", F.col("label").alias("hs4_label")), "hs4_id")
        .join(
            chapters.select(
                F.col("id").alias("chapter_id"), "section_id", "chapter_code", F.col("label").alias("chapter_label")
            ),
            "chapter_id",
        )
        .join(
            sections.select(F.col("id").alias("section_id"), "section_code", F.col("label").alias("section_label")),
            "section_id",
        )
    )
    return products.select("hs10", "hs6_id", "designation").join(path, "hs6_id").select(
        "hs10", "designation", "section_code", "section_label", "chapter_code", "chapter_label",
        "hs4", "hs4_label", "hs6", "hs6_label",
    )
