"""CSV export and the audit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmill.functions.jsontext import spaced, spaced_json_text
from tariffmill.functions.text import clean_label
from tariffmill.patterns import DEFAULT_RULES, EXPORT_CLEAN_COLUMNS, Rules
from tariffmill.session import remove_path
from tariffmill.sources.store import TABLES, CatalogueStore

BOM = "﻿"
#: Columns that hold compact JSON as text; exports have all JSON spaced.
JSON_TEXT_COLUMNS = ("raw",)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _export_value(field: T.StructField, rules: Rules) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _NESTED):
        value = spaced_json_text(value)
    elif isinstance(field.dataType, T.BooleanType):
        value = F.initcap(value.cast("string"))
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        value = F.regexp_replace(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
    elif field.name in JSON_TEXT_COLUMNS:
        value = spaced(value)
    elif field.name in EXPORT_CLEAN_COLUMNS:
        value = clean_label(value, rules)
    return value.alias(field.name)


def export_rows(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The columns as they are written: JSON text, True/False, cleaned labels."""
    return df.select(*[_export_value(field, rules) for field in df.schema])


def sink_csv_export(df: DataFrame, path: str, rules: Rules = DEFAULT_RULES) -> bool:
    """Write a table as semicolon CSV with header and byte order mark; an empty table leaves no export. Rows are counted as
    they are written, so the plan runs once."""
    seen = Observation()
    rows = export_rows(df, rules).observe(seen, F.count(F.lit(1)).alias("rows"))
    first = rows.columns[0]
    (
        rows.withColumnRenamed(first, BOM + first)
        .write.mode("overwrite")
        .options(sep=";", header=True, quote='"', escape='"', emptyValue="", nullValue="")
        .csv(path)
    )
    if not seen.get["rows"]:
        remove_path(df.sparkSession, path)
    return bool(seen.get["rows"])


def export_catalogue(store: CatalogueStore, root: str, rules: Rules = DEFAULT_RULES) -> list[str]:
    """Export the catalogue's tables, each to a folder of its name; the names of those that had rows."""
    return [name for name in TABLES if sink_csv_export(store.read(name), f"{root.rstrip('/')}/{name}", rules)]


def read_csv_export(spark, path: str) -> DataFrame:
    """An export read back with text columns, so that codes keep their leading zeros."""
    df = spark.read.options(sep=";", header=True, quote='"', escape='"', multiLine=True).csv(path)
    return df.toDF(*[c.removeprefix(BOM) for c in df.columns])


def sink_audit_append(audit: DataFrame, path: str, as_of: Column) -> None:
    """Append (hs10, status, message, duration_ms) to the audit log."""
    audit.select("hs10", "status", "message", "duration_ms", as_of.alias("created_at")).write.mode("append").parquet(path)
