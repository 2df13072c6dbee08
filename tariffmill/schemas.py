"""StructTypes of the inputs, the nested product and the catalogue tables."""

from __future__ import annotations

from pyspark.sql import types as T

STR = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


CODE_LIST_SCHEMA = _struct(("hs_code", STR))

TABLE_TYPE = _struct(
    ("headers", T.ArrayType(STR)),
    ("rows", T.ArrayType(T.MapType(STR, STR))),
    ("row_count", T.IntegerType()),
)

CONTENT_TYPE = _struct(
    ("raw_text", STR),
    ("metadata", T.MapType(STR, STR)),
    ("key_values", T.MapType(STR, STR)),
    ("tables", T.ArrayType(TABLE_TYPE)),
    ("length", T.IntegerType()),
)

SECTION_TYPE = _struct(
    ("section_name", STR),
    ("section_type", STR),
    ("content", CONTENT_TYPE),
    ("order", T.IntegerType()),
    ("scraped_at", STR),
)

RAW_SCHEMA = _struct(
    ("hs_code", STR),
    ("scraped_at", STR),
    ("scrape_status", STR),
    ("url", STR),
    ("main_content", CONTENT_TYPE),
    ("sections", T.ArrayType(SECTION_TYPE)),
    ("summary", STR),
    ("error", STR),
)

#: One landed page: the main page of a visit, or the page of one section.
LANDED_SCHEMA = _struct(
    ("hs_code", STR), ("scraped_at", STR), ("kind", STR), ("section_name", STR), ("order", T.IntegerType()), ("html", STR),
    ("error", STR),
)

PAGE_SCHEMA = _struct(("page_id", T.LongType()), ("url", STR), ("html", STR))

META_TYPE = _struct(("source", STR), ("scraped_at", STR), ("parser_version", STR), ("lang", STR))

AUDIT_SCHEMA = _struct(
    ("hs10", STR),
    ("status", STR),
    ("message", STR),
    ("duration_ms", T.IntegerType()),
    ("created_at", T.TimestampNTZType()),
)

SECTIONS_SCHEMA = _struct(
    ("id", T.LongType()),
    ("section_code", STR),
    ("label", STR),
    ("meta", META_TYPE),
    ("updated_at", T.TimestampNTZType()),
)

CHAPTERS_SCHEMA = _struct(
    ("id", T.LongType()),
    ("section_id", T.LongType()),
    ("chapter_code", STR),
    ("label", STR),
    ("meta", META_TYPE),
    ("updated_at", T.TimestampNTZType()),
)


def node_schema(parent_col: str, code_col: str) -> T.StructType:
    """Schema of ``hs4_nodes`` (chapter_id, hs4) and ``hs6_nodes`` (hs4_id, hs6)."""
    return _struct(
        ("id", T.LongType()),
        (parent_col, T.LongType()),
        (code_col, STR),
        ("label", STR),
        ("present", T.BooleanType()),
        ("meta", META_TYPE),
        ("updated_at", T.TimestampNTZType()),
    )


HS4_SCHEMA = node_schema("chapter_id", "hs4")
HS6_SCHEMA = node_schema("hs4_id", "hs6")

TAX_TYPE = _struct(("code", STR), ("label", STR), ("raw", STR))
DOCUMENT_TYPE = _struct(("code", STR), ("issuer", STR), ("name", STR), ("raw", STR))
AGREEMENT_TYPE = _struct(("DI", STR), ("TPI", STR), ("country", STR), ("list", STR), ("raw", STR))
HISTORY_TYPE = _struct(("date", STR), ("raw", STR))

LINEAGE_TYPE = _struct(
    ("scraped_at", STR),
    ("status", STR),
    ("url", STR),
    ("http", _struct(("status_code", T.IntegerType()), ("etag", STR), ("last_modified", STR))),
    ("pipeline", _struct(("scraper", STR), ("parser_version", STR), ("schema_version", STR))),
    (
        "quality",
        _struct(
            ("encoding_fixed", T.BooleanType()),
            ("missing_sections", T.ArrayType(STR)),
            ("warnings", T.ArrayType(STR)),
        ),
    ),
    ("sources", T.ArrayType(STR)),
    ("errors", T.ArrayType(STR)),
)

PRODUCTS_SCHEMA = _struct(
    ("hs10", STR),
    ("hs6_id", T.LongType()),
    ("hs4", STR),
    ("hs6", STR),
    ("hs8", STR),
    ("hs8_label", STR),
    ("section_label", STR),
    ("chapter_label", STR),
    ("hs4_label", STR),
    ("hs6_label", STR),
    ("designation", STR),
    ("unit_of_measure", STR),
    ("taxation", _struct(("taxes", T.ArrayType(TAX_TYPE)), ("meta", META_TYPE))),
    ("documents", _struct(("documents", T.ArrayType(DOCUMENT_TYPE)), ("meta", META_TYPE))),
    ("agreements", _struct(("accord_convention", T.ArrayType(AGREEMENT_TYPE)), ("meta", META_TYPE))),
    ("import_duty_history", _struct(("items", T.ArrayType(HISTORY_TYPE)), ("meta", META_TYPE))),
    ("lineage", LINEAGE_TYPE),
    ("raw", STR),
    ("canonical_hash", STR),
    ("canonical_text", STR),
    ("updated_at", T.TimestampNTZType()),
)
