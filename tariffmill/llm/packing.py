"""Best-fit packing of documents into fixed-length token sequences, with certified bin counts."""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmill.llm.common import keep, map_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: How byte-level tokenizers of this family split text before merging (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def merge_ranks(vocabulary: dict[str, int], merges: list) -> dict[bytes, int] | None:
    """Byte strings and ids of a byte-level vocabulary whose merges are numbered in order; else None."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if [vocabulary.get("".join(p)) for p in pairs] != list(range(256, 256 + len(pairs))):
        return None
    made = {"".join(p) for p in pairs} | set(byte_of)
    return {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token in made}


class TokenBytes:
    """Token ids of a whole text as little-endian 32-bit numbers.

    The tokenizer's own file is read; where its merges allow, its table is handed to a faster byte-pair encoder, and
    texts that hold one of its added tokens go to the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = self.exact = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        described = json.loads(tokenizer.to_str())
        self.added = [t["content"] for t in described["added_tokens"]]
        before = described["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not described["normalizer"]
        ranks = plain and merge_ranks(described["model"]["vocab"], described["model"]["merges"])
        if ranks:
            import tiktoken

            self.encode = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        encode = self.exact if any(t in text for t in self.added) else self.encode
        return array("I", encode(text)).tobytes()


_LOADED: dict[str, TokenBytes] = {}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: documents end with ``end_id``; only longer ones are cut, the first piece
    taking the remainder. A null text is empty, so each document has at least one token."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if tokenizer not in _LOADED:
            _LOADED[tokenizer] = TokenBytes(tokenizer)
        known, end = _LOADED[tokenizer], np.asarray([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            ids = known(text or "") + end
            n = len(ids) // 4
            first = n % capacity or capacity
            cuts = [0, *range(first, n + 1, capacity)]
            rows += (
                (doc, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
            )
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECES)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """A number of bins no packing can go below: the best of the volume bound and dual-feasible functions.

    ``counts[s]`` is the number of items of size ``s``. For each threshold ``k`` up to half the capacity, sizes over
    ``capacity - k`` count as a whole bin and those below ``k`` as nothing; and for each small integer ``m`` a size
    counts as ``floor((m + 1) * size / capacity) / m``, its own share where that is whole. Both functions map every
    feasible bin to at most one, so the sum over all items, rounded up, is a bound.
    """
    size = np.arange(len(counts), dtype=np.int64)
    best = -(-int((size * counts).sum()) // capacity)
    tail = np.concatenate([np.cumsum((size * counts)[::-1])[::-1], [0]])
    number = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    for k in range(1, capacity // 2 + 1):
        middle = int(tail[k] - tail[capacity - k + 1])
        best = max(best, int(number[capacity - k + 1]) + -(-middle // capacity))
    for m in range(1, 21):
        scaled = (m + 1) * size
        # in units of 1 / (m * capacity)
        worth = np.where(scaled % capacity == 0, m * size, scaled // capacity * capacity)
        best = max(best, -(-int((worth * counts).sum()) // (m * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: largest items first, each into the fullest bin it fits."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fills: list[int] = []
    open_rooms: list[int] = []  # sorted free sizes that occur
    by_room: dict[int, list[int]] = {}
    for i in order.tolist():
        need = int(lengths[i])
        at = bisect_left(open_rooms, need)
        if at < len(open_rooms):
            room = open_rooms[at]
            own = by_room[room]
            b = own.pop()
            if not own:
                open_rooms.pop(at)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += need
        if room := room - need:
            own = by_room.setdefault(room, [])
            if not own:
                insort(open_rooms, room)
            own.append(b)
    return bins, offsets, np.asarray(fills, np.int64)


def _pack_group(capacity: int):
    """Pack one group and say which of its bins are settled.

    A group that meets its bound is certified: no packing of it has fewer bins. All of them are settled but for the emptiest,
    whose room may serve other groups' documents. A group with a gap opens its emptiest bins, as many as have, all together,
    the room of the bins it has too many: with less room none of these can be saved.
    """
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        gap = len(fills) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        emptiest = np.argsort(fills, kind="stable")
        room = np.cumsum(capacity - fills[emptiest])
        opened = 1 + int(np.searchsorted(room, gap * capacity)) if gap else 1
        settled = np.ones(len(fills), bool)
        settled[emptiest[:opened]] = fills[emptiest[:opened]] == capacity
        return pdf.assign(bin=bins, offset=offsets, over_bound=gap, settled=settled[bins])

    return run


def pack(pieces: DataFrame, capacity: int = 1024, group_rows: int = 20_000) -> DataFrame:
    """Give each piece ``(doc_id, piece, length, ...)`` a sequence and an offset, in as few sequences as can be.

    Pieces that fill a sequence alone take one each. The rest is dealt to groups of about ``group_rows`` and packed best
    fit decreasing; a dual-feasible bound certifies each group's number of bins. Certified groups are settled but for one
    bin each; groups with a gap open their emptiest bins. What is not settled is exchanged: dealt anew to fewer groups,
    and packed again. This ends with a single group, or when a round does not lower the number of bins that its pieces had
    before it; then these keep the bins they had. Rows keep their other columns and get ``sequence_id``, ``offset`` and
    ``over_bound`` (bins of its group beyond the bound, an upper limit of what was lost there).
    Equal rows are packed one by one; an empty input gives an empty result. Lengths must be 1 to ``capacity``.
    """
    base = [c for c in pieces.columns if c not in ("bin", "offset", "over_bound", "sequence_id", "settled", "g")]
    pieces = pieces.select(*base)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    packed_schema = f"{schema}, g long, bin long, offset long, over_bound long, settled boolean"
    # a number for each full piece, without a shuffle: the row number Spark gives within the partition
    done = [
        pieces.where(F.col("length") == capacity).select(
            *base, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("over_bound")
        )
    ]

    def numbered(rows: DataFrame, step: int) -> DataFrame:
        # ids of rounds are kept apart below zero: round, group, bin
        place = -(((F.lit(step).cast("long") * (1 << 30) + F.col("g")) * (1 << 29)) + F.col("bin") + 1)
        return rows.select(*base, place.alias("sequence_id"), "offset", "over_bound")

    left, n, step = pieces.where(F.col("length") < capacity), None, 0
    kept: DataFrame | None = None  # the pieces that are left, with the bins they had
    bins_before = 0
    while True:
        n = left.count() if n is None else n
        if not n:
            break
        groups = max(1, round(n / group_rows))
        dealt = left.withColumn("g", F.pmod(F.xxhash64(F.lit(step), "doc_id", "piece"), F.lit(groups)))
        tried = keep(dealt.groupBy("g").applyInPandas(_pack_group(capacity), packed_schema), "bins")
        # per group its bins, and the pieces and bins that are not settled; only the sums go to the driver
        open_bin = F.when(~F.col("settled"), F.col("bin"))
        sums = tried.groupBy("g").agg(
            (F.max("bin") + 1).alias("bins"), F.count(open_bin).alias("rows"), F.count_distinct(open_bin).alias("open_bins")
        ).agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("bins", "rows", "open_bins")]).first()
        if kept is not None and sums[0] >= bins_before:
            done.append(numbered(kept, step - 1))
            break
        if groups == 1:
            done.append(numbered(tried, step))
            break
        done.append(numbered(tried.where("settled"), step))
        kept = tried.where("not settled")
        left, n, bins_before, step = kept.select(*base), sums[1], sums[2], step + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, group_rows: int = 20_000
) -> DataFrame:
    """Tokenize, cut and pack ``docs (doc_id, text, ...)``: one row per piece.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, over_bound. Null and empty texts are the end
    token alone. Rows with equal or null doc_id are packed as separate documents. Other columns are ignored.
    """
    pieces = keep(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity, group_rows)
