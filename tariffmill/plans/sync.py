"""One batch of raw records into the catalogue: parse, check, merge the touched chapters, audit, commit."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tariffmill.functions.text import zfill_code
from tariffmill.operators import checks, merge, report
from tariffmill.patterns import DEFAULT_RULES, MISSING, Rules
from tariffmill.plans.product import assemble_product, derive_prefixes, present_in_table, validate_product
from tariffmill.sources.store import LEVELS, NODES, PART, TABLES, TOP, CatalogueStore, node_part, product_part

_FIRST, _LAST = "_first_at", "_last_at"
UNKNOWN_CODE = "Unknown"
_PATH = ["section_code", "chapter_code", "hs4", "hs6"]


def hierarchy_nodes(good: DataFrame) -> DataFrame:
    """One row per hierarchy path of the batch, with the first labels and meta and the last labels.

    Arrival order is (scraped_at, hs_code). All node upserts work on this small frame.
    """
    h = "hierarchy"
    flat = good.select(
        zfill_code(F.col(f"{h}.section_code")).alias("section_code"),
        zfill_code(F.col(f"{h}.chapter_code")).alias("chapter_code"),
        F.col(f"{h}.hs4.code").alias("hs4"),
        F.col(f"{h}.hs6.code").alias("hs6"),
        F.struct("lineage.scraped_at", "hs_code").alias("at"),
        F.struct(f"{h}.section_label", f"{h}.chapter_label", f"{h}.meta").alias("early"),
        F.struct(F.col(f"{h}.hs4.label").alias("hs4_label"), F.col(f"{h}.hs6.label").alias("hs6_label")).alias("late"),
    )
    return flat.groupBy(*_PATH).agg(
        F.min_by("early", "at").alias("early"),
        F.max_by("late", "at").alias("late"),
        F.min("at").alias(_FIRST),
        F.max("at").alias(_LAST),
    )


def path_id(*codes: Column | str) -> Column:
    """Id of a hierarchy node from the codes on its path.

    Checked codes are digits of fixed width, 14 in all, so the path itself is a unique number. Ids need
    no look-up, no join from products to nodes, and come out the same when a batch is run again.
    """
    return F.concat(F.lit("1"), *codes).cast("bigint")


@dataclass(frozen=True)
class LoadCounts:
    """What a load has seen, counted while its records were written: no job of its own."""

    processed: int
    quarantined: int
    warned: int


def _chapter_bits() -> list[Column]:
    """The chapters of the good rows, a bit each: two digits make a hundred, so two numbers hold them all."""
    chapter = F.when(F.col("failure").isNull(), F.substring("hs_code", 1, 2).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), chapter % 50)
    return [F.bit_or(F.when(F.floor(chapter / 50) == half, bit)).alias(f"chapters_{half}") for half in (0, 1)]


def _chapters(metrics: dict) -> list[str]:
    bits = (metrics["chapters_0"] or 0) | (metrics["chapters_1"] or 0) << 50
    return [f"{i:02d}" for i in range(100) if bits >> i & 1]


def observed(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """The checked rows with their counts taken as they pass."""
    seen = Observation()
    count = F.lit(1)
    return checked.observe(
        seen, F.count(count).alias("processed"), F.count(F.when(F.col("failure").isNotNull(), count)).alias("quarantined"),
        F.count(F.when(F.size("warnings") > 0, count)).alias("warned"), *_chapter_bits(),
    ), seen


def merged_nodes(store: CatalogueStore, nodes: DataFrame, parts: list[str], now: Column) -> DataFrame:
    """The nodes of the touched parts after a batch, all levels in one aggregate.

    Sections and chapters keep the first label ever seen, deeper nodes take the last one; meta and time stay as first set.
    """
    ids = [path_id(*_PATH[: i + 1]) for i in range(4)]
    labels = ["early.section_label", "early.chapter_label", "late.hs4_label", "late.hs6_label"]
    key = ["level", "id", "parent_id", "code", PART]

    def level(i: int, name: str) -> Column:
        return F.struct(
            F.lit(name).alias("level"), ids[i].alias("id"), (ids[i - 1] if i else F.lit(None).cast("long")).alias("parent_id"),
            F.col(_PATH[i]).alias("code"), F.col(labels[i]).alias("label"),
            (present_in_table(F.col(labels[i])) if i > 1 else F.lit(None).cast("boolean")).alias("present"),
            (F.lit(TOP) if i < 2 else node_part(F.col(_PATH[i]))).alias(PART),
        )

    levels = F.array(*[level(i, name) for i, name in enumerate(LEVELS)])
    incoming = nodes.select(
        F.inline(levels), F.col("early.meta").alias("meta"), now.alias("updated_at"),
        F.struct(F.lit(1).alias("incoming"), _FIRST).alias(_FIRST), F.struct(F.lit(1).alias("incoming"), _LAST).alias(_LAST),
    )
    # stored rows come before all incoming ones
    stored = F.struct(F.lit(0).alias("incoming"), F.lit(None).cast(nodes.schema[_FIRST].dataType).alias(_FIRST))
    known = store.stored(NODES, [TOP, *{p[0] for p in parts}]).withColumns({_FIRST: stored, _LAST: stored})
    both = known.select(*incoming.columns).union(incoming)
    merged = both.groupBy(*key).agg(
        F.min_by(F.struct("label", "meta", "updated_at"), _FIRST).alias("early"),
        F.max_by(F.struct("label", "present"), _LAST).alias("late"),
    )
    label = F.when(F.col(PART) == TOP, F.col("early.label")).otherwise(F.col("late.label"))
    return merged.select(*key, label.alias("label"), "late.present", "early.meta", "early.updated_at")


def sync_batch(
    raw: DataFrame, store: CatalogueStore, source: str, batch_no: int, as_of: datetime, rules: Rules = DEFAULT_RULES
) -> LoadCounts | None:
    """Load batch ``batch_no`` of ``source``; None if it was loaded before, in which case nothing changes.

    A batch that does not follow the source's others raises. Warnings of the schema check go into the audit message.
    """
    store.recover()
    if store.has(source, batch_no):
        return None
    spark, now = store.spark, F.lit(as_of).cast("timestamp_ntz")

    # parsed once into shared storage; the merges below each read the few columns they need
    checked = validate_product(assemble_product(raw, now, rules)).withColumn("failure", checks.product_failure())
    rows, seen = observed(checked)
    staged = store.pending("staged")
    rows.write.parquet(staged)
    metrics = seen.get
    products = spark.read.schema(checked.schema).parquet(staged)
    good, bad = checks.split_good_bad(products, F.col("failure"))
    # only the chapters of the batch are read and written
    parts = _chapters(metrics)

    nodes = merged_nodes(store, hierarchy_nodes(good), parts, now)

    codes = derive_prefixes(F.col("hs_code"))
    incoming = good.select(
        F.col("hs_code").alias("hs10"),
        path_id(
            zfill_code(F.col("hierarchy.section_code")), zfill_code(F.col("hierarchy.chapter_code")),
            codes["hs4"], codes["hs6"],
        ).alias("hs6_id"),
        *[code.alias(name) for name, code in codes.items()],
        "hs8_label", "section_label", "chapter_label", "hs4_label", "hs6_label", "designation", "unit_of_measure",
        "taxation", "documents", F.col("accord_convention").alias("agreements"),
        F.col("historique").alias("import_duty_history"), "lineage", "raw", "canonical_hash", "canonical_text",
        F.struct("lineage.scraped_at", "hs_code").alias("_at"),
    )
    known = store.stored("hs_products", parts)
    target = known.select("hs10", "hs6_id", "canonical_hash", "updated_at")
    columns = TABLES["hs_products"].fieldNames()
    touched = merge.upsert_on_hash_change(target, incoming, ["hs10"], ["_at"], now).select(*columns)
    whole = merge.apply_touched(known, touched.withColumn(PART, product_part(F.col("hs10"))), ["hs10"])

    warned = F.when(F.size("warnings") > 0, F.array_join("warnings", "; "))
    audit = products.select(
        F.when(F.col("hs_code") != MISSING, F.col("hs_code")).otherwise(UNKNOWN_CODE).alias("hs10"),
        report.audit_status(F.col("failure")).alias("status"),
        F.coalesce("failure", warned).alias("message"),
        F.lit(None).cast("int").alias("duration_ms"),
        now.alias("created_at"),
    )
    writes = [
        partial(store.prepare, "hs_products", whole), partial(store.prepare, NODES, nodes), partial(store.set_aside, "audit_logs", audit),
    ]
    if metrics["quarantined"]:
        kept = bad.select(F.col("hs_code").alias("hs10"), "failure", "raw")
        writes.append(partial(store.set_aside, "quarantine", kept))
    # the tables do not depend on each other, so one job's last tasks and another's planning overlap
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()
    store.commit(source, batch_no)
    return LoadCounts(*(metrics[name] for name in ("processed", "quarantined", "warned")))
