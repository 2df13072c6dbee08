"""Queries that land raw records as files and merge them into a catalogue by stream and by batch."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from bindings import render as R
from bindings.records import RECORDS_SQL, parsed_records
from bindings.registry import query, spread_table, table
from tariffmill.plans.run import refresh
from tariffmill.plans.records import records_from_pages
from tariffmill.plans.sync import LoadCounts, sync_batch
from tariffmill.schemas import RAW_SCHEMA
from tariffmill.session import shared_dir
from tariffmill.sources.readers import spread, src_raw_json
from tariffmill.sources.sinks import read_csv_export
from tariffmill.sources.store import CatalogueStore
from tariffmill.streaming.ingest import read_landed_pages, read_landing, stream_id, stream_ingest, stream_records, write_records

AS_OF = datetime(2026, 2, 1)
_FACTS = f"WITH facts AS ({R.SQL_PART_FACTS})"
_LOADED = f"""{_FACTS}
  SELECT hs10, hs4, hs6, section_code, chapter_code, designation, hs4_label, hs6_label, sha256(payload) AS canonical_hash,
    TIMESTAMP '2026-02-01' AS updated_at FROM (SELECT *, sec AS section_code, chap AS chapter_code FROM ({R.SQL_PART_ITEMS}))"""


def _files(spark) -> int:
    """Files of one landing, and so of one micro-batch: all cores write them, however large the table is."""
    return spark.sparkContext.defaultParallelism


def _land(spark, d, parts: int, landing: str, keep=None) -> None:
    """Write part records as JSON files into a landing folder, dealt row by row to so many micro-batches. Only the narrow rows
    of the table pass through few tasks; records are rendered and written by all cores."""
    part = table(spark, d, "part")
    dealt = part if parts == 1 else part.repartition(parts).withColumn("batch", F.spark_partition_id())
    for batch in range(parts):
        rows = dealt if parts == 1 else dealt.where(F.col("batch") == batch).drop("batch")
        raw = R.raw_records(spread(rows, _files(spark)))
        (raw if keep is None else raw.where(keep)).write.mode("append").json(landing)


def _run_stream(spark, landing: str, root: str, checkpoint: str = "checkpoint", skip_days=None) -> list[LoadCounts]:
    raw, counts = read_landing(spark, landing, max_files=_files(spark)), []
    stream_ingest(raw, root, f"{root}/{checkpoint}", clock=lambda: AS_OF, skip_days=skip_days, on_load=counts.append).awaitTermination()
    return counts


def _loaded(spark, root: str):
    """Products with the codes of their section and chapter found over the stored ids."""
    store = CatalogueStore(spark, root)
    sections = store.read("sections", ["id", "section_code"]).withColumnRenamed("id", "section_id")
    chapters = store.read("chapters", ["id", "section_id", "chapter_code"]).withColumnRenamed("id", "chapter_id")
    hs4 = store.read("hs4_nodes", ["id", "chapter_id"]).withColumnRenamed("id", "hs4_id")
    hs6 = store.read("hs6_nodes", ["id", "hs4_id"]).withColumnRenamed("id", "hs6_id")
    path = hs6.join(hs4, "hs4_id").join(chapters, "chapter_id").join(sections, "section_id")
    products = store.read("hs_products")
    return products.join(path, "hs6_id").select(
        "hs10", "hs4", "hs6", "section_code", "chapter_code", "designation", "hs4_label", "hs6_label", "canonical_hash", "updated_at"
    )


@query("stream_ingest", _LOADED)
def stream_ingest_query(spark, d):
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "catalogue")
    _land(spark, d, 3, landing)
    _run_stream(spark, landing, root)
    return _loaded(spark, root)


@query("stream_resume", _LOADED)
def stream_resume(spark, d):
    """A stream stops after a third of the records, starts again, a second landing folder with its own checkpoint adds the
    rest, and the first stream's last batch is replayed at a later time, which changes nothing."""
    landing, other, root = shared_dir(spark, "landing"), shared_dir(spark, "landing"), shared_dir(spark, "catalogue")
    _land(spark, d, 1, landing, F.col("hs_code") < "3")
    _run_stream(spark, landing, root)
    _land(spark, d, 1, landing, F.col("hs_code").between("3", "6"))
    _run_stream(spark, landing, root)
    _land(spark, d, 1, other, (F.col("hs_code") > "6"))
    _run_stream(spark, other, root, checkpoint="checkpoint-2")
    raw, source = src_raw_json(spark, landing, multi_line=False), stream_id(spark, f"{root}/checkpoint")
    sync_batch(raw, CatalogueStore(spark, root), source, 1, datetime(2030, 1, 1))
    return _loaded(spark, root)


@query("stream_equals_batch", f"{_FACTS} SELECT hs10, true AS in_stream, true AS in_batch FROM facts")
def stream_equals_batch(spark, d):
    """Rows of both catalogues side by side; a row that differs anywhere shows up once per side."""
    landing, stream_root, batch_root = (shared_dir(spark, n) for n in ("landing", "catalogue", "catalogue"))
    _land(spark, d, 2, landing)
    _run_stream(spark, landing, stream_root)
    sync_batch(src_raw_json(spark, landing, multi_line=False), CatalogueStore(spark, batch_root), "landing", 0, AS_OF)
    streamed = _loaded(spark, stream_root).withColumn("side", F.lit("stream"))
    batched = _loaded(spark, batch_root).withColumn("side", F.lit("batch"))
    both = streamed.unionByName(batched)
    columns = [c for c in both.columns if c != "side"]
    return both.groupBy(*columns).agg(
        F.max(F.col("side") == "stream").alias("in_stream"), F.max(F.col("side") == "batch").alias("in_batch")
    ).select("hs10", "in_stream", "in_batch")


def _counted(spark, rows: list[tuple]):
    """Counts of a few loads as rows."""
    names = ["run", "processed", "quarantined", "warned"]
    made = [spark.range(1).select(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return reduce(lambda a, b: a.unionByName(b), made)


def _sum(counts: list[LoadCounts]) -> tuple[int, int, int]:
    return tuple(sum(getattr(c, name) for c in counts) for name in ("processed", "quarantined", "warned"))


@query("stream_visits", RECORDS_SQL)
def stream_visits(spark, d):
    """Landed pages as a stream of visits: a visit's pages lie in three landings, those of one come once more after all
    others, and a page of a later visit closes what is open. The stream stops and starts again in between."""
    pages = R.landed_pages(spread(table(spark, d, "part"), _files(spark)))
    landing, out = shared_dir(spark, "landing"), shared_dir(spark, "records")

    def land(rows):
        rows.write.mode("append").json(landing)

    def run():
        records = stream_records(read_landed_pages(spark, landing, max_files=_files(spark)))
        write_records(records, f"{out}/rows", f"{out}/checkpoint").awaitTermination()

    for third in range(3):
        land(pages.where(F.pmod(F.col("order"), F.lit(3)) == third))
    run()
    land(pages.where(F.pmod(F.col("order"), F.lit(3)) == 0))
    land(pages.limit(1).withColumn("scraped_at", F.lit("2026-02-28T00:00:00")))
    run()
    return parsed_records(spark.read.schema(RAW_SCHEMA).parquet(f"{out}/rows"))


@query("stream_skips_loaded", f"""{_FACTS}
  SELECT 1 AS run, count(*) AS processed FROM facts WHERE hs10 < '3' UNION ALL SELECT 2, count(*) FROM facts WHERE NOT hs10 < '3'""")
def stream_skips_loaded(spark, d):
    """Records parsed by a stream that stops after a third, and by another one that then finds all records landed."""
    first, second, root = shared_dir(spark, "landing"), shared_dir(spark, "landing"), shared_dir(spark, "catalogue")
    _land(spark, d, 1, first, F.col("hs_code") < "3")
    _land(spark, d, 2, second)
    runs = [_run_stream(spark, first, root, skip_days=25), _run_stream(spark, second, root, checkpoint="checkpoint-2", skip_days=25)]
    return _counted(spark, [(i + 1, *_sum(c)) for i, c in enumerate(runs)]).select("run", "processed")


@query("load_counts", f"""{_FACTS}
  SELECT 1 AS run, count(*) AS processed, count(*) FILTER (p_partkey % 10 = 1 OR by_key) AS quarantined,
    count(*) FILTER (p_partkey % 5 = 0) AS warned FROM facts
  UNION ALL SELECT 2, count(*), 0, count(*) FILTER (p_partkey % 5 = 0) FROM facts""")
def load_counts(spark, d):
    """What a batch of records from pages (1) and a stream of raw records (2) count while they load."""
    landing, batch_root, stream_root = shared_dir(spark, "landing"), shared_dir(spark, "catalogue"), shared_dir(spark, "catalogue")
    records = records_from_pages(R.landed_pages(spread_table(spark, d, "part")))
    batch = sync_batch(records, CatalogueStore(spark, batch_root), "pages", 0, AS_OF)
    _land(spark, d, 2, landing)
    return _counted(spark, [(1, *_sum([batch])), (2, *_sum(_run_stream(spark, landing, stream_root)))])


@query("run_pipeline", f"""{_FACTS}, listed AS (SELECT hs10, p_partkey % 10 = 1 OR by_key AS failed FROM facts)
  SELECT 1 AS run, count(*) AS listed, 0 AS skipped, count(*) AS processed, count(*) FILTER (NOT failed) AS exported FROM listed
  UNION ALL SELECT 2, count(*), count(*) FILTER (NOT failed), count(*) FILTER (failed), count(*) FILTER (NOT failed) FROM listed""")
def run_pipeline(spark, d):
    """Two runs of one day over the same landed pages: the second skips what the first has loaded, not
    visits that failed or records whose text names no section."""
    part = spread_table(spark, d, "part")
    pages, root, out = R.landed_pages(part), shared_dir(spark, "catalogue"), shared_dir(spark, "export")
    codes = R.part_facts(part).select(F.col("hs10").alias("hs_code"), F.col("p_partkey").alias("input_pos"))
    found = []
    for run in (1, 2):
        counts = refresh(codes, pages, CatalogueStore(spark, root), "runs", run, AS_OF, export_root=out)
        exported = read_csv_export(spark, f"{out}/hs_products").count()
        found.append(counts.select(F.lit(run).alias("run"), "*", F.lit(exported).cast("long").alias("exported")))
    return found[0].unionByName(found[1])
