"""Scratch tables, text helpers and connected components shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of rows that tasks send to Python at a time; without it 10,000 rows, however wide.
BATCH_BYTES = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def keep(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: lineage is cut and lost executors lose nothing.

    Its rows go to Python in batches of bounded bytes, unless the session has a bound of its own.
    """
    path = f"{scratch_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    conf, bound = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    given = conf.get(bound, None) is not None
    if not given:
        conf.set(bound, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        if not given:
            conf.unset(bound)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = 1000) -> DataFrame:
    """``fn`` over Arrow batches of at most ``rows`` rows; results that are None or empty are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = fn(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def table_of(batch: pa.RecordBatch) -> dict[str, list]:
    """The columns of a batch as Python lists."""
    return batch.to_pydict()


def encoded(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: 64-bit numbers to well-spread 64-bit numbers, one to one."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _digest() -> Callable[[bytes], int]:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest


class WordHash(dict):
    """64-bit hashes of words, remembered up to a fixed number of words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = _digest()(word)
        return value


def shingle_hashes(words: list[bytes], size: int, known: WordHash) -> np.ndarray:
    """Distinct 64-bit hashes of all runs of ``size`` words, sorted; a shorter text is one run; no words, none."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    acc = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        acc = mixed(acc ^ h[i : len(h) - width + 1 + i])
    return np.unique(acc)


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node with the smallest node of its group."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_pydict(
        {"a": pa.array(nodes, pa.int64()), "b": pa.array([root(x) for x in nodes], pa.int64())}
    )


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Groups that links ``(a, b)`` connect, as ``(node, component)`` with the smallest member as component.

    Each task first contracts its own links by union-find; then every node is linked to the smallest of its
    neighbours, larger ones and smaller ones in turn, until each group is a star. Only sums go to the driver. Nodes
    without a link to another are not listed; links of a node to itself and nulls are ignored. The rounds grow with
    the logarithm of the longest path; running out of them raises.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    state = keep(links.mapInArrow(_local_forest, "a long, b long"), "links")
    before = None
    for _ in range(max_rounds):
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == before:
            break
        before = mark
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        pairs = down.join(low, "a")
        small = pairs.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
        state = keep(small.where("a <> b").distinct(), "links")
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    members = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
