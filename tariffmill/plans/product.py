"""Raw records to nested products: one projection chain, no shuffle."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.functions import html, lines, parse
from tariffmill.functions.jsontext import canonical_json, json_text
from tariffmill.functions.text import blank_to_null
from tariffmill.patterns import DEFAULT_RULES, MISSING, Rules
from tariffmill.schemas import RAW_SCHEMA


def section_content(sections: Column, name: str) -> Column:
    """Content of a section; the last one wins where a name repeats, NULL where there is none."""
    named = F.filter(sections, lambda s: s["section_name"] == name)
    return F.try_element_at(named, F.lit(-1))["content"]


def section_map(sections: Column) -> Column:
    """Map of section name to content, last one wins."""
    return html.last_wins_map(
        F.transform(sections, lambda s: F.struct(s["section_name"].alias("key"), s["content"].alias("value")))
    )


def order_sections(sections: Column) -> Column:
    """Sections in navigation order."""
    keyed = F.transform(sections, lambda s, i: F.struct(s["order"].alias("order"), i.alias("at"), s.alias("section")))
    # array_sort compares whole structs; order and place decide before the section is looked at
    placed = F.array_sort(
        keyed,
        lambda a, b: F.when(a["order"] < b["order"], -1)
        .when(a["order"] > b["order"], 1)
        .otherwise(a["at"] - b["at"]),
    )
    return F.transform(placed, lambda e: e["section"])


def derive_prefixes(code: Column) -> dict[str, Column]:
    """The 4, 6 and 8 digit codes above a full code."""
    return {f"hs{n}": F.substring(code, 1, n) for n in (4, 6, 8)}


def scraped_at_or(scraped_at: Column, as_of: Column) -> Column:
    """The fetch time, or the run time as ISO text with a Z."""
    run_time = F.concat(F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return F.coalesce(blank_to_null(scraped_at), run_time)


def meta_struct(scraped_at: Column) -> Column:
    return F.struct(
        F.lit(P.META_SOURCE).alias("source"),
        scraped_at.alias("scraped_at"),
        F.lit(P.PARSER_VERSION).alias("parser_version"),
        F.lit(P.LANGUAGE).alias("lang"),
    )


def lineage_struct(scraped_at: Column, status: Column, url: Column) -> Column:
    null = F.lit(None).cast("string")
    none = F.array().cast("array<string>")
    return F.struct(
        scraped_at.alias("scraped_at"),
        F.coalesce(status, F.lit("success")).alias("status"),
        url.alias("url"),
        F.struct(
            F.lit(200).alias("status_code"), null.alias("etag"), null.alias("last_modified")
        ).alias("http"),
        F.struct(
            F.lit(P.SCRAPER_NAME).alias("scraper"),
            F.lit(P.PARSER_VERSION).alias("parser_version"),
            F.lit(P.SCHEMA_VERSION).alias("schema_version"),
        ).alias("pipeline"),
        F.struct(
            F.lit(True).alias("encoding_fixed"), none.alias("missing_sections"), none.alias("warnings")
        ).alias("quality"),
        F.array(F.lit(P.META_SOURCE)).alias("sources"),
        none.alias("errors"),
    )


def canonical_payload(
    agreements: Column, designation: Column, documents: Column, history: Column, taxes: Column
) -> Column:
    """What the hash covers, keys in sorted order. Labels, unit and meta are not in it."""

    def sorted_fields(items: Column, *fields: str) -> Column:
        return F.transform(items, lambda item: F.struct(*[item[f].alias(f) for f in fields]))

    return F.struct(
        sorted_fields(agreements, "DI", "TPI", "country", "list", "raw").alias("agreements"),
        designation.alias("designation"),
        sorted_fields(documents, "code", "issuer", "name", "raw").alias("documents"),
        sorted_fields(history, "date", "raw").alias("history"),
        sorted_fields(taxes, "code", "label", "raw").alias("taxation"),
    )


def canonical_hash(payload: Column) -> Column:
    return F.sha2(canonical_json(payload), 256)


def canonical_text(designation: Column) -> Column:
    """A missing designation reads ``None``."""
    return F.concat(F.lit("Designation: "), F.coalesce(designation, F.lit("None")), F.lit("\n"))


def assemble_product(raw: DataFrame, as_of: Column, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Raw records (``RAW_SCHEMA``) to nested product rows."""
    whole = json_text(F.struct(*RAW_SCHEMA.fieldNames()))
    df = raw.withColumn("raw", whole).withColumns({
        "hs_code": F.coalesce(F.col("hs_code"), F.lit(MISSING)),
        "scraped_at": scraped_at_or(F.col("scraped_at"), as_of),
    })
    *stages, product = _product_stages(rules, raw.sparkSession.sparkContext.applicationId)
    for stage in stages:
        df = df.withColumns(stage)
    return df.select(*[column.alias(name) for name, column in product.items()])


@lru_cache(maxsize=8)
def _product_stages(rules: Rules, application: str) -> tuple[dict[str, Column], ...]:
    """Columns to add step by step, and last the columns of the product.

    Columns are not bound to a DataFrame, so a stream builds these wide expressions once per application
    and not once per batch.
    """
    col = F.col
    sections = {
        "_pos": P.SECTION_POSITION,
        "_tax": P.SECTION_TAXES,
        "_doc": P.SECTION_DOCUMENTS,
        "_agr": P.SECTION_AGREEMENTS,
        "_his": P.SECTION_HISTORY,
    }
    text, pairs = F.coalesce(col("_pos.raw_text"), F.lit("")), col("_pos.key_values")
    parsed = {
        "_section": parse.extract_section(text, pairs, rules),
        "_chapter": parse.extract_chapter(text, pairs, rules),
        "_designation": parse.extract_designation(text, pairs, col("hs_code"), rules),
        "_unit": lines.unit_of_measure(text, col("_pos.metadata")),
        "_taxes": parse.taxes(
            parse.parse_taxes(col("_tax.raw_text"), rules), parse.parse_taxes_kv(col("_tax.key_values"), rules)
        ),
        "_documents": lines.parse_documents(col("_doc.raw_text"), rules),
        "_agreements": lines.parse_agreements(col("_agr.raw_text"), rules),
        "_history": lines.parse_history(col("_his.raw_text")),
    }
    meta = meta_struct(col("scraped_at"))
    payload = canonical_payload(
        col("_agreements"), col("_final"), col("_documents"), col("_history"), col("_taxes")
    )

    def node(width: int) -> Column:
        label = col(f"_labels.hs{width}_label")
        return F.struct(
            F.substring("hs_code", 1, width).alias("code"),
            label.alias("label"),
            present_in_record(label).alias("present"),
        ).alias(f"hs{width}")

    def with_meta(items: str, name: str) -> Column:
        return F.struct(col(items).alias(name), meta.alias("meta"))

    product = {
        "hs_code": col("hs_code"),
        "section_label": col("_section.label"),
        "chapter_label": col("_chapter.label"),
        "hs4_label": col("_labels.hs4_label"),
        "hs6_label": col("_labels.hs6_label"),
        "hs8_label": col("_labels.hs8_label"),
        "designation": col("_final"),
        "unit_of_measure": col("_unit"),
        "hierarchy": F.struct(
            col("_section.code").alias("section_code"),
            col("_section.label").alias("section_label"),
            col("_chapter.code").alias("chapter_code"),
            col("_chapter.label").alias("chapter_label"),
            node(4),
            node(6),
            node(8),
            meta.alias("meta"),
        ),
        "taxation": with_meta("_taxes", "taxes"),
        "documents": with_meta("_documents", "documents"),
        "accord_convention": with_meta("_agreements", "accord_convention"),
        "historique": with_meta("_history", "items"),
        "lineage": lineage_struct(col("scraped_at"), col("scrape_status"), col("url")),
        "raw": col("raw"),
        "canonical_hash": canonical_hash(payload),
        "canonical_text": canonical_text(col("_final")),
    }
    return (
        {alias: section_content(col("sections"), name) for alias, name in sections.items()},
        parsed,
        {"_labels": lines.hierarchy_labels(text, col("hs_code"), col("_designation"), rules)},
        {"_final": lines.final_designation(col("_labels.hs10_label"), col("_designation"))},
        product,
    )


def present_in_record(label: Column) -> Column:
    """In the record a level is present unless its label is the missing marker."""
    return label.isNull() | (label != MISSING)


def present_in_table(label: Column) -> Column:
    """In the node tables a level is present when it has any label, the missing marker included."""
    return label.isNotNull()


def validation_warnings(product: DataFrame) -> Column:
    """Names of the schema rules a product row breaks; the row is kept all the same."""

    def missing_in(items: str, field: str) -> Column:
        return F.exists(F.col(items), lambda item: item[field].isNull())

    rules: dict[str, Callable[[], Column]] = {
        "hs_code": lambda: F.col("hs_code").isNull(),
        "lineage": lambda: F.col("lineage").isNull(),
        "taxation.taxes.code": lambda: missing_in("taxation.taxes", "code"),
        "documents.documents.code": lambda: missing_in("documents.documents", "code"),
        "documents.documents.name": lambda: missing_in("documents.documents", "name"),
        "documents.documents.issuer": lambda: missing_in("documents.documents", "issuer"),
        "accord_convention.accord_convention.country": lambda: missing_in(
            "accord_convention.accord_convention", "country"
        ),
        "accord_convention.accord_convention.DI": lambda: missing_in("accord_convention.accord_convention", "DI"),
        "accord_convention.accord_convention.TPI": lambda: missing_in("accord_convention.accord_convention", "TPI"),
        "historique.items.date": lambda: missing_in("historique.items", "date"),
    }
    known = {name: test() for name, test in rules.items() if name.split(".")[0] in product.columns}
    return F.filter(
        F.array(*[F.when(test, f"{name}: missing") for name, test in known.items()]), lambda w: w.isNotNull()
    )


def validate_product(product: DataFrame) -> DataFrame:
    return product.withColumn("warnings", validation_warnings(product))


