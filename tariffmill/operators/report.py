"""Health report over the audit log, audit status, and the export preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill.patterns import ETA_ITEMS


def audit_status(failure: Column) -> Column:
    """Status of a record from its error message; no message means success."""
    lowered = F.lower(failure)
    invalid = F.contains(lowered, F.lit("validation")) | F.contains(lowered, F.lit("valueerror"))
    return F.when(failure.isNull(), "SUCCESS").when(invalid, "VALIDATION_ERROR").otherwise("FAILED")


def _is_success() -> Column:
    return F.col("status") == "SUCCESS"


def audit_success_rate(audit: DataFrame) -> DataFrame:
    """Total, successes and success percentage; no row for an empty log."""
    totals = audit.agg(F.count("*").alias("total"), F.count(F.when(_is_success(), 1)).alias("success"))
    return totals.where("total > 0").withColumn("success_rate", F.col("success") / F.col("total") * 100)


def audit_avg_duration(audit: DataFrame) -> DataFrame:
    """Mean duration of the successes in ms, 0 without any."""
    mean = F.avg(F.when(_is_success(), F.col("duration_ms")))
    return audit.agg(F.coalesce(mean, F.lit(0.0)).alias("avg_ms"))


def audit_eta(audit: DataFrame, items: int = ETA_ITEMS) -> DataFrame:
    """Mean seconds per code, and hours for a full run of ``items`` codes."""
    seconds = F.col("avg_ms") / 1000
    return audit_avg_duration(audit).select(
        seconds.alias("avg_seconds"), (seconds * items / 3600).alias("eta_hours")
    )


def audit_top_errors(audit: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent failures by status and first 100 characters of the message."""
    return (
        audit.where(~_is_success())
        .groupBy("status", F.substring("message", 1, 100).alias("msg"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "status", "msg")
        .limit(n)
    )


def health_report(audit: DataFrame, items: int = ETA_ITEMS) -> DataFrame:
    """The figures of the report in one row and one pass over the log."""
    totals = audit.agg(
        F.count("*").alias("total"),
        F.count(F.when(_is_success(), 1)).alias("success"),
        F.coalesce(F.avg(F.when(_is_success(), F.col("duration_ms"))), F.lit(0.0)).alias("avg_ms"),
    )
    seconds = F.col("avg_ms") / 1000
    return totals.where("total > 0").select(
        "total",
        "success",
        (F.col("success") / F.col("total") * 100).alias("success_rate"),
        seconds.alias("avg_seconds"),
        (seconds * items / 3600).alias("eta_hours"),
    )


def export_preview(products: DataFrame, n: int = 5) -> DataFrame:
    """Last n products by code, each with the number of all products."""
    total = products.select("hs10").agg(F.count("*")).first()[0]
    last = products.select("hs10", "designation", "section_label").orderBy(F.desc("hs10")).limit(n)
    return last.withColumn("total", F.lit(total).cast("long"))
