"""Raw records as they land, merged into the catalogue in micro-batches."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tariffmill.operators.delta import delta_anti_join, keys_to_skip
from tariffmill.patterns import DEFAULT_RULES, Rules
from tariffmill.plans.records import records_from_pages, visits
from tariffmill.plans.sync import LoadCounts, sync_batch
from tariffmill.schemas import LANDED_SCHEMA, RAW_SCHEMA
from tariffmill.sources.store import CatalogueStore


#: State of streams lies on local disk, beside caches that all stores of an executor share.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read_landing(spark: SparkSession, landing: str, max_files: int = 100) -> DataFrame:
    """New files of a landing folder, one JSON record per line, oldest first."""
    return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files).json(landing)


def read_landed_pages(spark: SparkSession, landing: str, max_files: int = 100) -> DataFrame:
    """New files of landed pages, one JSON page per line, oldest first."""
    return spark.readStream.schema(LANDED_SCHEMA).option("maxFilesPerTrigger", max_files).json(landing)


def stream_records(pages: DataFrame, late: str = "1 hour") -> DataFrame:
    """A stream of landed pages as a stream of raw records, one per visit, whose pages may come in any files, more than once
    and late by so much. Its output mode is append."""
    return records_from_pages(visits(pages, late))


def write_records(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write a stream of raw records as Parquet; ends when all landed files are done.

    Open visits are kept on local disk and not in memory, however many there are; a state store that the session names itself
    is left as it is, and a checkpoint keeps the one it was made with.
    """
    conf = records.sparkSession.conf
    provider = next(iter(STATE))
    own = {} if conf.get(provider, "").rpartition(".")[2] not in ("", "HDFSBackedStateStoreProvider") else STATE
    given = {name: conf.get(name, None) for name in own}
    try:
        for name, value in own.items():
            conf.set(name, value)
        # the stream takes the session's settings as it starts
        return records.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    finally:
        for name, value in given.items():
            conf.unset(name) if value is None else conf.set(name, value)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint was made; it stays over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_ingest(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    rules: Rules = DEFAULT_RULES,
    clock: Callable[[], datetime] = utc_now,
    skip_days: int | None = None,
    on_load: Callable[[LoadCounts], None] | None = None,
) -> StreamingQuery:
    """Merge a stream of raw records into the store under ``root``; ends when all landed files are done.

    A batch is known by the stream's id, which its checkpoint holds, and its number there. After a crash the stream
    runs its last batch again, which then is found loaded or is loaded anew; another landing folder, or a new
    checkpoint, is another source and adds to the store.

    With ``skip_days`` codes that the store holds as refreshed in so many days are left out of a batch before anything of them
    is parsed; the skip set is the store's at the start of each batch, so it also holds what was loaded before a crash, and
    by other streams. ``on_load`` is told what each loaded batch has seen.
    """
    sources: list[str] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not sources:
            sources.append(stream_id(spark, checkpoint))
        store, now = CatalogueStore(spark, root), clock()
        if skip_days is not None:
            store.recover()
            batch = delta_anti_join(batch, keys_to_skip(store, now, skip_days))
        counts = sync_batch(batch, store, sources[0], batch_id, now, rules)
        if counts and on_load:
            on_load(counts)

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
