"""Near-duplicate groups: SuperMinHash signatures, banding, verification on whole shingle sets, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmill.llm.common import WordHash, components, encoded, keep, map_batches, mixed, shingle_hashes

_WORDS = WordHash()
LEVEL = np.uint64(24)
#: Members of a bucket that are compared in one part.
PART_ROWS = 500


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes: A-Z lower-cased, words split at ASCII white space."""
    return shingle_hashes(encoded(text).lower().split(), size, _WORDS)


def superminhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, length: int) -> np.ndarray:
    """SuperMinHash signatures of ``n_sets`` sets; ``elements[i]`` belongs to set ``owner[i]``.

    Each element has a random permutation of the positions, drawn step by step; at step ``j`` it offers the value
    ``j + random`` to the position its permutation visits there, and a position keeps the least offer. Ranks within one
    element differ, which lowers the variance. All sets take step ``j`` together, and a set stops as soon as every
    position holds an offer of an earlier step than the next, since later ones are larger. Values are 8 bits of step and
    24 random bits.
    """
    best = np.full(n_sets * length, np.iinfo(np.uint32).max, np.uint32)
    live = np.arange(len(elements))
    order = None
    for j in range(length):
        draw = mixed(elements[live] + np.uint64((j + 1) * 0xD1342543DE82EF95 % 2**64))
        to = (j + (((draw >> np.uint64(32)) * np.uint64(length - j)) >> np.uint64(32))).astype(np.int64)
        rows = np.arange(len(live))
        if order is None:
            at = to
        else:
            at = order[rows, to].astype(np.int64)
            order[rows, to] = order[:, j]
        value = ((np.uint64(j) << LEVEL) | (draw & np.uint64((1 << 24) - 1))).astype(np.uint32)
        np.minimum.at(best, owner[live] * length + at, value)
        open_sets = best.reshape(n_sets, length).max(1) >= np.uint32((j + 1) << 24) if j + 1 < length else np.zeros(n_sets, bool)
        stay = open_sets[owner[live]]
        if not stay.any():
            break
        if order is None:
            # the first step's swap, made only for elements that go on
            order = np.tile(np.arange(length, dtype=np.uint8), (int(stay.sum()), 1))
            order[np.arange(len(order)), to[stay]] = 0
        else:
            order = order[stay]
        live = live[stay]
    return best.reshape(n_sets, length)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature positions, with the band's number mixed in."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    for i in range(rows):
        key = mixed(key ^ parts[:, :, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Per document: number of shingles, a 128-bit key of the whole set, band keys, and the signature's low bytes."""
    length = bands * rows
    if length > 255:
        raise ValueError("bands * rows must be under 256")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        from xxhash import xxh3_128_digest

        sets = [shingles(t, size) for t in batch["text"].to_pylist()]
        numbers = [len(s) for s in sets]
        sig = np.empty((len(sets), length), np.uint32)
        # about as many elements at a time as bounds the permutations in memory
        start, total = 0, 0
        for i, n in enumerate(numbers):
            total += n
            if total > 60_000 or i + 1 == len(sets):
                part = sets[start : i + 1]
                owner = np.repeat(np.arange(len(part)), [len(s) for s in part])
                sig[start : i + 1] = superminhash(np.concatenate(part), owner, len(part), length)
                start, total = i + 1, 0
        keys = band_keys(sig, bands, rows)
        filled = np.asarray(numbers) > 0
        offsets = np.concatenate([[0], np.cumsum(np.where(filled, bands, 0))]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(numbers, pa.int64()),
                pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[filled].ravel())),
                pa.array([row.astype(np.uint8).tobytes() for row in sig], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "set_key", "keys", "low"],
        )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(narrow, run, "doc_id long, n_shingles long, set_key binary, keys array<long>, low binary", 500)


def _similar(n_a: str, n_b: str, percent: int):
    """Sets of such sizes can have the similarity at all."""
    return (F.least(n_a, n_b) * 100) >= (F.greatest(n_a, n_b) * percent)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole shingle sets reach the similarity, from ``texts (doc_id, text)``.

    ``b`` is the side that many pairs may share; rows come sorted by it where Spark merges, so its set is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            out_a, out_b = [], []
            for a, b, text_a, text_b in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if b != last:
                    last, held = b, shingles(text_b, size)
                if _linked(shingles(text_a, size), held, percent):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def _close(bands: int, length: int, size: int, percent: int, least: float):
    """Links across groups of a bucket: pairs whose signatures agree in at least ``least`` of the positions (by their low
    bytes, so never fewer) and whose whole shingle sets reach the similarity. Rows come sorted by part of a bucket, and a part is
    held at a time. Of the buckets two documents share only that of their first common band looks at the pair."""

    def pairs(part: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        own = [r for r in part if r[1]]
        every = [r for r in part if not r[1]]
        if not own or not every:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        key, main = part[0][0], part[0][6]
        x, y = (np.asarray([r[2] for r in side], np.int64) for side in (own, every))
        c_x, c_y = (np.asarray([r[3] for r in side], np.int64) for side in (own, every))
        n_x, n_y = (np.asarray([r[4] for r in side], np.int64) for side in (own, every))
        keys_x, keys_y = (np.asarray([r[5] for r in side], np.int64).reshape(-1, bands) for side in (own, every))
        low_x, low_y = (np.frombuffer(b"".join(r[7] for r in side), np.uint8).reshape(-1, length) for side in (own, every))
        band = int(np.flatnonzero(keys_x[0] == key)[0])
        out_a, out_b = [], []
        sets: dict[int, np.ndarray] = {}

        def set_of(side: list[tuple], j: int) -> np.ndarray:
            doc, text = side[j][2], side[j][8]
            if doc not in sets:
                sets[doc] = shingles(text, size)
            return sets[doc]

        for i in range(len(own)):
            fits = (c_y != c_x[i]) & ((c_y == main) | (x[i] > y))
            fits &= np.minimum(n_y, n_x[i]) * 100 >= np.maximum(n_y, n_x[i]) * percent
            fits[fits] = ~(keys_y[fits, :band] == keys_x[i, :band]).any(1)
            fits[fits] = (low_y[fits] == low_x[i]).mean(1) >= least
            for j in np.flatnonzero(fits).tolist():
                if _linked(set_of(own, i), set_of(every, j), percent):
                    out_a.append(x[i])
                    out_b.append(y[j])
        return np.asarray(out_a, np.int64), np.asarray(out_b, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "own", "doc_id", "component", "n", "keys", "main", "low", "text")
        part: list[tuple] = []
        at = None
        for batch in batches:
            found = []
            places = zip(*(batch[c].to_pylist() for c in ("key", "chunk", "block")), strict=True)
            for place, row in zip(places, zip(*(batch[c].to_pylist() for c in names), strict=True), strict=True):
                if place != at:
                    if part:
                        found.append(pairs(part))
                    at, part = place, []
                part.append(row)
            if found:
                yield _pair_rows(found)
        if part:
            yield _pair_rows([pairs(part)])

    return run


def _pair_rows(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, least: float = 0.6
) -> DataFrame:
    """Groups of documents that links of at least ``percent`` Jaccard similarity connect.

    Works on ``docs (doc_id, text, ...)``: a document's set are its distinct runs of ``size`` words, a shorter text
    being one run. Documents with equal sets are one class from the start, so copies cost one row. Class
    representatives are banded by SuperMinHash; at similarity 0.8 a pair shares none of 32 bands of 5 with a chance of
    3e-6. Each shared bucket links its members to its most connected one, so a bucket of ``n`` gives ``n - 1`` pairs.
    Where a bucket still holds several groups after these links are verified, the members outside its main group are
    compared with all members of other groups there, by their signatures (``least``: over six standard deviations
    below 0.8) and whole sets, in parts of bounded size; only links come out of it. Every link is confirmed on whole sets.

    Null and empty texts have no set and stay alone. Rows that share a doc_id are taken as one document. Returns
    doc_id, n_shingles, component_id (smallest doc_id of the group) and kept, one row per input row.
    """
    signed = keep(signatures(docs, size, bands, rows), "signed")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    classes = keep(filled.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    reps = filled.join(classes.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"], "left_semi")
    banded = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    hits = keep(banded.join(shared, "key"), "hits")
    degree = hits.groupBy("doc_id").agg(F.sum(F.col("held") - 1).alias("degree"))
    ranked = hits.join(degree, "doc_id")
    leaders = keep(
        ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"), F.col("n").alias("n_b"))).alias("top")).select(
            "key", (-F.col("top.minus")).alias("b"), "top.n_b"
        ),
        "leaders",
    )
    first = hits.join(leaders, "key").where(F.col("doc_id") != F.col("b")).where(_similar("n", "n_b", percent))
    first = keep(first.select(F.col("doc_id").alias("a"), "b").distinct(), "pairs")
    in_buckets = hits.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = keep(texts.join(in_buckets, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    links = keep(verify(first, texts, size, percent), "links")
    groups = keep(components(links), "groups")

    # buckets that still hold several groups: all pairs across groups that have a member outside the main one
    placed = hits.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    mixed_up = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    placed = keep(placed.join(mixed_up.select("key"), "key", "left_semi"), "mixed")
    main = placed.join(leaders.select("key", F.col("b").alias("doc_id")), ["key", "doc_id"]).select("key", F.col("component").alias("main"))
    apart = placed.join(main, "key").withColumn("own", F.col("component") != F.col("main"))
    # a bucket in parts: a share of the members outside its main group against a share of all members
    sizes = apart.groupBy("key").agg(F.sum(F.col("own").cast("int")).alias("n_own"), F.count("*").alias("n_all"))
    chunks, blocks = (F.greatest(F.ceil(F.col(c) / PART_ROWS), F.lit(1)).cast("int") for c in ("n_own", "n_all"))
    apart = apart.join(sizes.select("key", chunks.alias("chunks"), blocks.alias("blocks")), "key")
    place = F.xxhash64("doc_id")
    every = F.struct(F.lit(False).alias("own"), F.lit(0).alias("chunk"), F.pmod(place, F.col("blocks")).cast("int").alias("block"))
    ones = F.struct(F.lit(True).alias("own"), F.pmod(place, F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("block"))
    as_member = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: F.struct(every["own"], i.alias("chunk"), every["block"]))
    as_own = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(ones["own"], ones["chunk"], i.alias("block")))
    roles = F.when(F.col("own"), F.concat(as_member, as_own)).otherwise(as_member)
    signed_reps = reps.select("doc_id", "keys", "low").join(apart.select("doc_id").distinct(), "doc_id", "left_semi")
    dealt = apart.withColumn("role", F.explode(roles)).drop("own").select("key", "doc_id", "component", "n", "main", "role.*")
    dealt = dealt.join(signed_reps.join(texts, "doc_id"), "doc_id")
    dealt = dealt.repartition("key", "chunk", "block").sortWithinPartitions("key", "chunk", "block")
    more = keep(dealt.mapInArrow(_close(bands, bands * rows, size, percent, least), "a long, b long").distinct(), "more")
    if not more.isEmpty():
        groups = keep(components(links.unionByName(more)), "groups")

    # each class has the group of its representative; a group's smallest representative is its smallest member
    placed = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    out = out.join(placed, "set_key", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
