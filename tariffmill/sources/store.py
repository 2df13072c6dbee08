"""Catalogue tables as Parquet folders, products by chapter, and one row per source that says which batches are loaded.

A batch merges the chapters it touches and puts just these partitions in the place of the old ones. They are written under
``pending`` first, and a batch counts once its mark stands there: lost before that, it leaves no trace; lost later, the next
batch goes on with what is pending, which gives the same tables. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmill import schemas as S
from tariffmill.session import path_exists, remove_path, replace_folders

PART = "part"
#: Sections and chapters, 10,000 of two digits each at most, lie in a part of their own.
TOP = "top"
NODES = "nodes"
NODES_SCHEMA = T.StructType([
    T.StructField("level", S.STR), T.StructField("id", T.LongType()), T.StructField("parent_id", T.LongType()),
    T.StructField("code", S.STR), T.StructField("label", S.STR), T.StructField("present", T.BooleanType()),
    T.StructField("meta", S.META_TYPE), T.StructField("updated_at", T.TimestampNTZType()),
])
#: Hierarchy tables, all kept in one: names of their parent and code columns.
LEVELS: dict[str, tuple[str | None, str]] = {
    "sections": (None, "section_code"), "chapters": ("section_id", "chapter_code"),
    "hs4_nodes": ("chapter_id", "hs4"), "hs6_nodes": ("hs4_id", "hs6"),
}
TABLES: dict[str, T.StructType] = {
    "sections": S.SECTIONS_SCHEMA, "chapters": S.CHAPTERS_SCHEMA, "hs4_nodes": S.HS4_SCHEMA, "hs6_nodes": S.HS6_SCHEMA,
    "hs_products": S.PRODUCTS_SCHEMA,
}
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("hs10", S.STR), T.StructField("failure", S.STR), T.StructField("raw", S.STR),
])
LOGS = {"audit_logs": S.AUDIT_SCHEMA, "quarantine": QUARANTINE_SCHEMA}
_STORED = {NODES: NODES_SCHEMA, "hs_products": S.PRODUCTS_SCHEMA, **LOGS}
_LOADED = "source string, first long, last long"


def product_part(hs10: Column) -> Column:
    """The chapter, first two digits of a checked code: 100 folders at most."""
    return F.substring(hs10, 1, 2)


def node_part(code: Column) -> Column:
    """HS4 and HS6 nodes are narrow and 1,010,000 at most per chapter label, so their first digit parts them."""
    return F.substring(code, 1, 1)


class CatalogueStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def pending(self, name: str) -> str:
        return self._path(f"pending/{name}")

    def _rows(self, name: str, schema: T.StructType | str) -> DataFrame:
        """A folder's rows; one that is not there is empty."""
        if path_exists(self.spark, self._path(name)):
            return self.spark.read.schema(schema).parquet(self._path(name))
        return self.spark.createDataFrame([], schema)

    def stored(self, name: str, parts: Sequence[str] | None = None) -> DataFrame:
        """Rows of a stored table with their part; ``parts`` limits the folders that are read."""
        rows = self._rows(name, T.StructType([*_STORED[name].fields, T.StructField(PART, S.STR)]))
        return rows if parts is None else rows.where(F.col(PART).isin(list(parts)))

    def read(self, table: str, columns: Sequence[str] | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """A table of the catalogue, or a log; ``parts`` are chapters."""
        if table in LOGS:
            rows = self._rows(table, LOGS[table])
        elif table in LEVELS:
            parent, code = LEVELS[table]
            top = [TOP] if table in ("sections", "chapters") else None if parts is None else {p[0] for p in parts}
            rows = self.stored(NODES, top).where(F.col("level") == table)
            rows = rows.withColumnsRenamed({"code": code, **({"parent_id": parent} if parent else {})})
        else:
            rows = self.stored(table, parts)
        names = (TABLES.get(table) or LOGS[table]).fieldNames()
        return rows.select(*(columns or names))

    def insert(self, name: str, rows: DataFrame, by: Sequence[str] = (PART,)) -> None:
        """Put whole partitions in the place of those of the same name; the others stay."""
        out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
        out.parquet(self._path(name))

    def prepare(self, name: str, rows: DataFrame) -> None:
        """Write the whole new content of touched parts aside. Rows of a part come together, a large part in several
        tasks, so a part that fits a task is one file."""
        rows.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(self.pending(name))

    def set_aside(self, name: str, rows: DataFrame) -> None:
        """Write a batch's rows of a log aside."""
        rows.write.mode("overwrite").parquet(self.pending(name))

    def _one_row(self, **values: str | int) -> DataFrame:
        columns = [F.lit(v).cast("string" if isinstance(v, str) else "long").alias(k) for k, v in values.items()]
        return self.spark.range(1).coalesce(1).select(*columns)

    def _mark(self) -> tuple[str, int] | None:
        if not path_exists(self.spark, self.pending("mark/_SUCCESS")):
            return None
        return tuple(self.spark.read.schema("source string, batch long").parquet(self.pending("mark")).first())

    def commit(self, source: str, batch: int) -> None:
        """Let what was prepared count, and put it back."""
        self._one_row(source=source, batch=batch).write.mode("overwrite").parquet(self.pending("mark"))
        self.recover()

    def recover(self) -> None:
        """Finish a batch that was lost after its mark, and clear one that was lost before."""
        mark = self._mark()
        if mark:
            source, batch = mark
            for name in (NODES, "hs_products"):
                replace_folders(self.spark, self.pending(name), self._path(name), f"{PART}=")
            for name in LOGS:
                if path_exists(self.spark, self.pending(name)):
                    rows = self.spark.read.schema(LOGS[name]).parquet(self.pending(name))
                    marked = rows.withColumns({"source": F.lit(source), "batch": F.lit(batch)})
                    self.insert(name, marked, ["source", "batch"])
            first, last = self._batches(source) or (batch, batch)
            self.insert("loaded", self._one_row(source=source, first=min(first, batch), last=max(last, batch)), ["source"])
        remove_path(self.spark, self._path("pending"))

    def _batches(self, source: str) -> tuple[int, int] | None:
        """First and last loaded batch of a source."""
        row = self._rows("loaded", _LOADED).where(F.col("source") == source).select("first", "last").first()
        return tuple(row) if row else None

    def has(self, source: str, batch: int) -> bool:
        """True if this batch of this source is loaded. A source's batches come one after the other, from any first
        number on; one before the first, or beyond the next, raises, so that none is ever left out unseen."""
        known = self._batches(source)
        if not known or batch == known[1] + 1:
            return False
        if known[0] <= batch <= known[1]:
            return True
        raise ValueError(f"batch {batch} of {source} does not follow batches {known[0]} to {known[1]}")
