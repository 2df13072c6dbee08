"""Line dedup that can be undone: exact reference tables, and a sharded cuckoo filter over them that saves look-ups.

A line's key is its stripped, lower-cased text, carried as a 128-bit BLAKE2 hash. The reference table holds one row per
key and document row, with +1 for an insertion and -1 for a deletion. A shard's filter holds a key's fingerprint once if
one row refers to it and twice if more do. So a key with no fingerprint is new and one with a single fingerprint is in
one row only, without a look at the table; all others are counted there, exactly. Wrong hits of the filter only cost
look-ups. Every step gives a new index beside the old one, so any of them can be taken back.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmill.llm.common import SPACES, encoded, keep, map_batches, mixed

#: Shorter keys are never dropped, so they are not kept track of.
LEAST_CHARS = 10
#: References for which a shard is made.
SHARD_ROWS = 100_000
#: A key with more than one in so many of all references is hot, so there are at most as many hot keys.
HOT = 1000
#: Stands for a missing doc_id, before all others.
NO_DOC = -(1 << 63)
_SPACES = SPACES.encode()
_KEY = ["hi", "lo"]


class CuckooFilter:
    """Sets of 16-bit fingerprints in buckets of four, each at home in two buckets; a key may be held several times.

    All operations take arrays of keys. When an insertion finds no room, a further layer of twice the buckets is opened.
    """

    SLOTS, KICKS, FULL = 4, 200, 0.85

    def __init__(self, buckets: int = 64, layers: list[np.ndarray] | None = None) -> None:
        self.layers = layers or [np.zeros((buckets, self.SLOTS), np.uint16)]

    @classmethod
    def for_keys(cls, count: int) -> CuckooFilter:
        least = max(16, int(count / cls.FULL / cls.SLOTS))
        return cls(1 << (least - 1).bit_length())

    def to_bytes(self) -> bytes:
        return b"".join(len(x).to_bytes(8, "little") + x.tobytes() for x in self.layers)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        layers, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            end = at + 8 + 2 * size * cls.SLOTS
            layers.append(np.frombuffer(data, np.uint16, size * cls.SLOTS, at + 8).reshape(size, cls.SLOTS).copy())
            at = end
        return cls(layers=layers)

    @staticmethod
    def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint, never 0, and the hash that gives the first bucket."""
        h = mixed(keys.astype(np.uint64))
        return (h >> np.uint64(48)).astype(np.uint16) | np.uint16(1), h & np.uint64(0xFFFFFFFF)

    @staticmethod
    def _other(bucket: np.ndarray, prints: np.ndarray, size: int) -> np.ndarray:
        return bucket ^ (mixed(prints.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)

    def count(self, keys: np.ndarray) -> np.ndarray:
        """How often each key may be held: never too low."""
        prints, home = self._places(keys)
        total = np.zeros(len(keys), np.int64)
        for layer in self.layers:
            first = (home & np.uint64(len(layer) - 1)).astype(np.int64)
            second = self._other(first, prints, len(layer))
            total += (layer[first] == prints[:, None]).sum(1)
            total += np.where(first == second, 0, (layer[second] == prints[:, None]).sum(1))
        return total

    def add(self, keys: np.ndarray) -> None:
        """Insert keys; one given twice is held twice."""
        prints, home = self._places(keys)
        while len(prints):
            layer = self.layers[-1]
            bucket = (home & np.uint64(len(layer) - 1)).astype(np.int64)
            room = int(self.FULL * layer.size) - np.count_nonzero(layer)
            now, later = slice(0, max(room, 0)), slice(max(room, 0), None)
            left, lost = self._place(layer, bucket[now], prints[now], home[now])
            prints, home = np.concatenate([left, prints[later]]), np.concatenate([lost, home[later]])
            if len(prints):
                self.layers.append(np.zeros((2 * len(layer), self.SLOTS), np.uint16))

    def _place(self, layer, bucket, prints, home):
        """Put fingerprints into a layer, all at once where they do not meet; those in the way move to their other bucket.

        If some find no place the layer is taken back as it was before them, and they are returned.
        """
        rng, tried_other = np.random.default_rng(len(prints)), False
        source = np.arange(len(prints))
        before = layer.copy()
        start_prints, start_home = prints, home
        for _ in range(self.KICKS):
            if not len(prints):
                return prints, home[:0]
            order = np.argsort(bucket, kind="stable")
            bucket, prints, source = bucket[order], prints[order], source[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = layer[bucket] == 0
            fits = rank < free.sum(1)
            slot = np.argsort(~free, axis=1, kind="stable")[fits, rank[fits]]
            layer[bucket[fits], slot] = prints[fits]
            bucket, prints, source = bucket[~fits], prints[~fits], source[~fits]
            if not tried_other:
                bucket, tried_other = self._other(bucket, prints, len(layer)), True
                continue
            # one of each full bucket takes a slot there, and what was in it goes to its other bucket
            chosen = np.concatenate([[True], bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, bool)
            at, slot = bucket[chosen], rng.integers(0, self.SLOTS, int(chosen.sum()))
            moved = layer[at, slot]
            layer[at, slot] = prints[chosen]
            bucket = np.concatenate([self._other(at, moved, len(layer)), bucket[~chosen]])
            prints = np.concatenate([moved, prints[~chosen]])
            source = np.concatenate([source[chosen], source[~chosen]])
        if not len(prints):
            return prints, home[:0]
        # too crowded: nothing of this call stays here
        layer[:] = before
        return start_prints, start_home

    def remove(self, keys: np.ndarray) -> None:
        """Take out one copy of each key's fingerprint; only for keys that were added."""
        prints, home = self._places(keys)
        for p, h in zip(prints, home, strict=True):
            for layer in reversed(self.layers):
                first = np.array([int(h) & (len(layer) - 1)])
                for b in (first, self._other(first, np.array([p]), len(layer))):
                    hit = np.flatnonzero(layer[b[0]] == p)
                    if len(hit):
                        layer[b[0], hit[0]] = 0
                        break
                else:
                    continue
                break
            else:
                raise KeyError("fingerprint not held")


def line_key(line: bytes) -> bytes | None:
    """128-bit key of a line; None if it is too short to be dropped. Only A-Z are lower-cased."""
    key = line.strip(_SPACES).lower()
    if len(key) < LEAST_CHARS or (len(key) < 4 * LEAST_CHARS and len(key.decode("utf-8", "surrogatepass")) < LEAST_CHARS):
        return None
    return blake2b(key, digest_size=16).digest()


def _line_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The distinct keys of each document row."""
    counts, found = [], []
    for text in batch["text"].to_pylist():
        keys = {line_key(line) for line in encoded(text).split(b"\n")} - {None}
        counts.append(len(keys))
        found += sorted(keys)
    halves = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 2)
    doc_ids = np.repeat(batch["doc_id"].to_numpy(zero_copy_only=False), counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(doc_ids, pa.int64())], names=["hi", "lo", "doc_id"]
    )


def _known(doc_id: str = "doc_id"):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_DOC))


def line_refs(docs: DataFrame) -> DataFrame:
    """One row (hi, lo, doc_id) for each key of each document row."""
    rows = docs.select(_known().alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, _line_keys, "hi long, lo long, doc_id long", 500)


@dataclass(frozen=True)
class LineIndex:
    """``refs``: hi, lo, doc_id, change; ``counts``: hi, lo, n, first, last, whose rows of one key are added up; ``filters``:
    shard, filter. All three are tables in the shared folder."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


@dataclass(frozen=True)
class Batch:
    """What an insertion read: the documents' references, and their distinct keys."""

    refs: DataFrame
    keys: DataFrame


def empty_index(spark: SparkSession, shards: int) -> LineIndex:
    refs = spark.createDataFrame([], "hi long, lo long, doc_id long, change int")
    counts = spark.createDataFrame([], "hi long, lo long, n long, first long, last long")
    return LineIndex(refs, counts, spark.createDataFrame([], "shard int, filter binary"), shards)


def totals(counts: DataFrame) -> DataFrame:
    """References of each key, and the first and last document."""
    return counts.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod("lo", F.lit(shards)).cast("int"))


def _with_filters(df: DataFrame, index: LineIndex, fn, schema: str) -> DataFrame:
    by = "shard"
    return _sharded(df, index.shards).groupBy(by).cogroup(index.filters.groupBy(by)).applyInArrow(fn, schema)


def _held(keys: pa.Table, filters: pa.Table) -> pa.Table:
    if not keys.num_rows:
        return pa.table({"hi": pa.array([], pa.int64()), "lo": pa.array([], pa.int64()), "held": pa.array([], pa.int64())})
    hi = keys["hi"].to_numpy()
    held = np.zeros(len(hi), np.int64)
    if filters.num_rows:
        held = CuckooFilter.from_bytes(filters["filter"][0].as_py()).count(hi)
    return pa.table({"hi": keys["hi"], "lo": keys["lo"], "held": pa.array(held)})


def probe(index: LineIndex, keys: DataFrame) -> DataFrame:
    """Distinct keys with the times that their shard's filter may hold them."""
    return _with_filters(keys.select(*_KEY), index, _held, "hi long, lo long, held long")


def _changed(key: tuple, keys: pa.Table, filters: pa.Table) -> pa.Table:
    shard = key[0].as_py()
    change, hi = keys["change"].to_numpy(), keys["hi"].to_numpy()
    times = np.abs(change)
    found = CuckooFilter.from_bytes(filters["filter"][0].as_py()) if filters.num_rows else CuckooFilter.for_keys(int(times.sum()))
    found.add(np.repeat(hi[change > 0], times[change > 0]))
    found.remove(np.repeat(hi[change < 0], times[change < 0]))
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([found.to_bytes()], pa.binary())})


def _refilter(index: LineIndex, keys: DataFrame, before, after) -> DataFrame:
    """Filters after the keys' reference counts have gone from ``before`` to ``after``."""
    change = (F.least(after, F.lit(2)) - F.least(before, F.lit(2))).cast("int").alias("change")
    moved = keys.select(*_KEY, change).where("change <> 0")
    return keep(_with_filters(moved, index, _changed, "shard int, filter binary"), "line-filters")


def insert(index: LineIndex | None, docs: DataFrame) -> tuple[LineIndex, Batch]:
    """The index with documents added, and what was read of them. Without an index a new one is made, with a shard for
    every ``SHARD_ROWS`` references. Rows of one doc_id are one document, also over several insertions."""
    refs = keep(line_refs(docs), "line-refs")
    if index is None:
        index = empty_index(docs.sparkSession, max(8, refs.count() // SHARD_ROWS))
    fresh = refs.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    fresh = keep(fresh, "line-counts")
    if index.filters.isEmpty():
        filters = _refilter(index, fresh, F.lit(0), F.col("n"))
    else:
        # keys that the filter does not hold are new; only the others are looked up
        asked = probe(index, fresh).where("held > 0").select(*_KEY)
        old = totals(index.counts.join(asked, _KEY, "left_semi")).select(*_KEY, F.col("n").alias("old"))
        both = fresh.join(old, _KEY, "left").withColumn("old", F.coalesce("old", F.lit(0)))
        filters = _refilter(index, both, F.col("old"), F.col("old") + F.col("n"))
    added = refs.withColumn("change", F.lit(1))
    index = LineIndex(index.refs.unionByName(added), index.counts.unionByName(fresh), filters, index.shards)
    return index, Batch(refs, fresh.select(*_KEY))


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without these documents (doc_id); ids it does not hold are ignored. Counts are taken anew from the
    references that are left."""
    gone = doc_ids.select(_known().alias("doc_id")).distinct()
    lost = index.refs.join(gone, "doc_id", "left_semi").groupBy(*_KEY, "doc_id").agg(F.sum("change").alias("n"))
    lost = keep(lost.where("n > 0").select(*_KEY, "doc_id", (-F.col("n")).cast("int").alias("change")), "line-refs")
    refs = index.refs.unionByName(lost)
    held = refs.groupBy(*_KEY, "doc_id").agg(F.sum("change").alias("n")).where("n > 0")
    counts = held.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    counts = keep(counts, "line-counts")
    fewer = lost.groupBy(*_KEY).agg(F.sum("change").alias("change"))
    moved = fewer.join(counts.select(*_KEY, "n"), _KEY, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    filters = _refilter(index, moved, F.col("n") - F.col("change"), F.col("n"))
    return LineIndex(refs, counts, filters, index.shards)


def shared_keys(index: LineIndex, keys: DataFrame) -> DataFrame:
    """Those of the distinct keys that at least two documents hold: (hi, lo, n, first)."""
    asked = probe(index, keys).where("held > 1").select(*_KEY)
    return totals(index.counts.join(asked, _KEY, "left_semi")).where("first < last").drop("last")


def _drop_lines(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts without the lines whose keys are listed."""
    n_lines, n_dropped, kept = [], [], []
    for text, dropped in zip(batch["text"].to_pylist(), batch["dropped"].to_pylist(), strict=True):
        lines = encoded(text).split(b"\n")
        left = lines
        if dropped:
            gone = set(dropped)
            left = [line for line in lines if line_key(line) not in gone]
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(left))
        kept.append(b"\n".join(left))
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())],
        names=["doc_id", "n_lines", "n_dropped", "kept"],
    )


def _as_bytes(column: str):
    """The eight bytes of a number, as they stand in the key."""
    return F.unhex(F.lpad(F.hex(column), 16, "0"))


def drop_shared_lines(index: LineIndex, docs: DataFrame, batch: Batch | None = None) -> DataFrame:
    """Each document row with ``n_lines``, ``n_dropped`` and ``kept``, its text (UTF-8) without the lines whose keys the index
    also has in a smaller doc_id. ``batch`` saves a second reading of documents that were just inserted.

    A missing text is one empty line. A missing doc_id counts as one document before all others. Rows of one doc_id are one
    document: a key in these alone is not shared. Lines with keys of less than ten code points always stay.
    """
    if batch is None:
        refs = keep(line_refs(docs), "line-refs")
        batch = Batch(refs, refs.select(*_KEY).distinct())
    shared = keep(shared_keys(index, batch.keys), "line-shared")
    # a key in more than one in HOT references is joined by broadcast: there are HOT such keys at most
    total = index.counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT > total
    few = F.broadcast(shared.where(hot).drop("n"))
    rest = batch.refs.join(F.broadcast(shared.where(hot).select(*_KEY)), _KEY, "left_anti").join(shared.where(~hot).drop("n"), _KEY)
    gone = batch.refs.join(few, _KEY).unionByName(rest).where("doc_id > first")
    key = F.concat(_as_bytes("hi"), _as_bytes("lo"))
    dropped = gone.groupBy("doc_id").agg(F.collect_set(key).alias("dropped")).withColumnRenamed("doc_id", "known")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _known().alias("known"))
    joined = rows.join(dropped, "known", "left").select("doc_id", "text", "dropped")
    return map_batches(joined, _drop_lines, "doc_id long, n_lines long, n_dropped long, kept binary", 500)
