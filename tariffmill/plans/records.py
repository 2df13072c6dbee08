"""Landed pages to raw records: page text, sections and status per visit of a code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmill.functions import html as H
from tariffmill.operators.delta import delta_anti_join, limit_codes
from tariffmill.operators.tables import with_tables
from tariffmill.plans.product import order_sections
from tariffmill.schemas import RAW_SCHEMA

MAIN_PAGE = "main"
#: When a visit was made, as a time; only streams need it.
VISIT_TIME = "visit_at"

# One landed page: the main page of a visit, or the page of one section.
LANDED_COLUMNS = ("hs_code", "scraped_at", "kind", "section_name", "order", "html", "error")


def pages_to_fetch(codes: DataFrame, skip: DataFrame, limit: int | None = None) -> DataFrame:
    """Codes of a run: listed, not fresh, and cut to the limit after that."""
    return limit_codes(delta_anti_join(codes, skip), limit)


def landed_of_codes(pages: DataFrame, codes: DataFrame) -> DataFrame:
    """Landed pages of the wanted codes."""
    return pages.join(codes.select("hs_code").distinct(), "hs_code", "left_semi")


def visits(pages: DataFrame, late: str) -> DataFrame:
    """A stream of landed pages with the time of their visit, for ``records_from_pages``.

    A visit is kept as state until pages of visits later by more than ``late`` have come, whatever files and micro-batches
    its own pages land in; then it becomes a record, its state goes, and pages of it that come still later are left out. A
    page without a readable time is of no visit and is left out too.
    """
    at = F.try_to_timestamp("scraped_at")
    return pages.withColumn(VISIT_TIME, at).where(F.col(VISIT_TIME).isNotNull()).withWatermark(VISIT_TIME, late)


def records_from_pages(pages: DataFrame) -> DataFrame:
    """Raw records (``RAW_SCHEMA``) from landed pages (``LANDED_COLUMNS``), one per code and visit.

    Pages are turned into text before anything is shuffled, so HTML never is. A section met twice in a
    visit is reduced to its last page by an aggregate that Spark combines early; what is then put
    together per visit are its distinct sections. Pages of a stream come from ``visits``; both aggregates then keep their
    groups as state.
    """
    visit = ["hs_code", "scraped_at"] + [VISIT_TIME] * (VISIT_TIME in pages.columns)
    parsed = with_tables(
        pages.select(*visit, "kind", "section_name", "order", "error", "html")
        .withColumn("text", H.html_to_text(F.col("html")))
        .withColumn("has_page", F.col("html").isNotNull()),
        html="html",
    )
    content = H.content_of_text(F.col("text"), F.col("tables"))
    typed = parsed.select(
        *visit, "kind", "section_name", "order", "error", "has_page",
        H.section_type(F.col("section_name"), F.col("text")).alias("section_type"),
        content.alias("content"),
    )
    main = F.col("kind") == MAIN_PAGE
    # a page that was fetched beats one that was not; then the later order, a missing one being the first; ties by text
    newest = F.struct("has_page", F.coalesce(F.col("order").cast("long"), F.lit(-1 << 40)), F.xxhash64("content.raw_text"))
    by_section = typed.groupBy(*visit, "kind", "section_name").agg(
        F.max_by(F.struct("section_type", "content", "order", "has_page"), newest).alias("page"),
        F.max("error").alias("error"),
    )
    section = F.struct(
        "section_name", "page.section_type", "page.content", "page.order", F.col("scraped_at").alias("scraped_at")
    )
    by_visit = by_section.groupBy(*visit).agg(
        F.collect_list(F.when(~main & F.col("page.has_page"), section)).alias("sections"),
        # one row of a visit at most
        F.first(F.when(main & F.col("page.has_page"), F.col("page.content")), ignorenulls=True).alias("main_content"),
        F.max("error").alias("error"),
    )
    sections = order_sections(F.col("sections")).cast(RAW_SCHEMA["sections"].dataType)
    failed = F.col("error").isNotNull()
    return by_visit.select(
        "hs_code",
        "scraped_at",
        H.scrape_status(F.col("error"), F.col("main_content.raw_text")).alias("scrape_status"),
        F.lit(None).cast("string").alias("url"),
        F.when(~failed, F.col("main_content")).alias("main_content"),
        F.when(failed, F.array().cast(RAW_SCHEMA["sections"].dataType)).otherwise(sections).alias("sections"),
        F.lit(None).cast("string").alias("summary"),
        "error",
    )
