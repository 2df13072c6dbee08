"""Data rules as DataFrames of violations, and the split of good from bad records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill.functions.text import zfill_code
from tariffmill.patterns import CODE_FORMATS


def format_failure(code: Column, kind: str) -> Column:
    """Message for a code that is not of its kind's form, else NULL. NULL codes are another rule's."""
    return F.when(
        ~F.rlike(code, F.lit(CODE_FORMATS[kind])), F.concat(F.lit(f"{kind} violates its format: "), code)
    )


def check_code_format(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per offending value with its count; ``columns`` maps column to kind of code.

    Counting before anything else keeps a value that fills a third of the table to one row per task.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), (~F.rlike(F.col(c), F.lit(CODE_FORMATS[kind]))).alias("bad"))
        for c, kind in columns.items()
    ]))
    return (
        df.select(pairs.alias("p"))
        .where("p.bad")
        .groupBy("p.column", "p.value")
        .agg(F.count("*").alias("n"))
    )


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULLs per column, in one pass; one output row per column."""
    columns = list(columns)
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]))
    )


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphan_check(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign key values without a parent, with the rows that hold them.

    Child rows are counted per key before the join, so a hot parent takes one row into it.
    """
    used = child.where(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key).alias(foreign_key))
    return used.join(parents, foreign_key, "left_anti")


def product_failure() -> Column:
    """First hard rule a product row breaks, in load order, as a message; NULL for a good row."""
    section, chapter = zfill_code(F.col("hierarchy.section_code")), zfill_code(F.col("hierarchy.chapter_code"))

    def missing(name: str, value: Column) -> Column:
        return F.when(value.isNull(), f"{name} violates not-null")

    return F.coalesce(
        missing("section_code", section),
        missing("section_label", F.col("hierarchy.section_label")),
        format_failure(section, "section_code"),
        missing("chapter_code", chapter),
        missing("chapter_label", F.col("hierarchy.chapter_label")),
        format_failure(chapter, "chapter_code"),
        format_failure(F.col("hierarchy.hs4.code"), "hs4"),
        format_failure(F.col("hierarchy.hs6.code"), "hs6"),
        missing("hs10", F.col("hs_code")),
        format_failure(F.col("hs_code"), "hs10"),
    )


def split_good_bad(df: DataFrame, failure: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a failure, rows with one and its message); bad rows never stop the good ones."""
    marked = df.withColumn("failure", failure)
    return marked.where("failure IS NULL").drop("failure"), marked.where("failure IS NOT NULL")
