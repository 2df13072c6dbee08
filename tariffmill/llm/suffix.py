"""Exact repeated passages: content-defined grouping, then interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmill.llm.common import encoded, keep, map_batches, mixed

#: Length of the strings whose hashes choose how windows are grouped.
GRAM = 24
#: A group with more different stretches, or more bytes in them, than this is split by whole windows.
MOST_STRETCHES = 4_000
MOST_BYTES = 16 << 20
BLOCK_BYTES = 1 << 18
#: Bytes whose intervals are expanded together.
EXPANDED = 1 << 20
ROWS = "key long, content long, doc_id long, start int, size int, looped boolean, done boolean"
SPANS = "doc_id long, start int, size int"

_BASE = 0x9E3779B97F4A7C55 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = mixed(np.arange(256, dtype=np.uint64)) | np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            row = np.full(max(n, 1 << 16), base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS[0][:n], _POWERS[1][:n]


def sums(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2**64 over randomised byte values."""
    up, _ = _powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the strings ``start:end``, equal for equal strings wherever they stand."""
    _, down = _powers(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start] ^ (end - start).astype(np.uint64))


def window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    out, have = h, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def stretches(raw: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows of ``length`` bytes that have the same least gram hash.

    Equal windows have equal hashes, so they meet in one group wherever they stand. Returns key, content hash, first window, bytes
    covered, and whether the key's gram occurs twice in the run (only then can a window repeat within it).
    """
    prefix = sums(raw)
    at = np.arange(len(raw) - GRAM + 1)
    grams = span_hash(prefix, at, at + GRAM)
    width = length - GRAM + 1
    least = window_minimum(grams, width)
    cut = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.concatenate([cut[1:], [len(least)]]) - 1
    key = least[cut]
    inner = np.concatenate([[0], np.cumsum(grams[: len(least)] == least)])
    number = inner[last + 1] - inner[cut]
    for d in range(1, width):
        number += grams[last + d] == key
    end = last + length
    return key, span_hash(prefix, cut, end), cut, end - cut, number > 1


def _first_of_batch(length: int):
    """Stretches of the documents of a batch. Of stretches with equal content only the first goes on to be compared; the
    others repeat it as a whole, whatever stands elsewhere."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found: list[tuple] = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            raw = np.frombuffer(encoded(text), np.uint8)
            if len(raw) >= length:
                key, content, start, size, looped = stretches(raw, length)
                found.append((key, content, np.full(len(key), doc, np.int64), start, size, looped))
        if not found:
            return None
        key, content, doc, start, size, looped = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, doc, content, key))
        key, content, doc, start, size, looped = (x[order] for x in (key, content, doc, start, size, looped))
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (content[1:] != content[:-1])])
        head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        # a repeated row of the same document is at the same place, and repeats nothing
        here = (doc == doc[head]) & (start == start[head])
        done = ~here
        spread = mixed(doc.astype(np.uint64) ^ start.astype(np.uint64))
        return _rows(np.where(done, spread, key), content, doc, start, size, looped, done)

    return run


def _rows(key, content, doc, start, size, looped, done) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int32)),
            pa.array(size.astype(np.int32)), pa.array(looped), pa.array(done),
        ],
        names=["key", "content", "doc_id", "start", "size", "looped", "done"],
    )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by key, content and place: repeats of a content are covered; a key with several contents, or one
    that loops, is left to the transform (``hard``). One row waits at most, so a key may have any number of rows."""
    names = ["key", "content", "doc_id", "start", "size", "looped"]
    waiting: dict[str, np.ndarray] | None = None  # the only content so far of the last key
    head: tuple | None = None  # the last key, content, and place of the content's first row
    several = False

    def out(rows: dict[str, np.ndarray], pick: np.ndarray, hard: bool) -> pa.RecordBatch:
        columns = [pa.array(rows[c][pick]) for c in ("doc_id", "start", "size", "key")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(int(pick.sum()), hard))], names=["doc_id", "start", "size", "key", "hard"])

    for batch in batches:
        rows = {c: batch[c].to_numpy(zero_copy_only=False) for c in [*names, "done"]}
        done = rows.pop("done").astype(bool)
        if done.any():
            yield out(rows, done, False)
            rows = {c: v[~done] for c, v in rows.items()}
        n = len(rows["key"])
        if not n:
            continue
        key, content = rows["key"], rows["content"]
        same_key = np.concatenate([[head is not None and head[0] == key[0]], key[1:] == key[:-1]])
        same = same_key & np.concatenate([[head is not None and head[1] == content[0]], content[1:] == content[:-1]])
        at = np.maximum.accumulate(np.where(~same, np.arange(n), -1))
        first_doc = np.where(at >= 0, rows["doc_id"][at], head[2] if head else 0)
        first_start = np.where(at >= 0, rows["start"][at], head[3] if head else 0)
        place = (rows["doc_id"] == first_doc) & (rows["start"] == first_start)
        covered = same & ~place
        if covered.any():
            yield out(rows, covered, False)
        fresh = ~same
        # contents per key within the batch; the key left open by the last batch may have had one or more already
        group = np.cumsum(~same_key) - (0 if same_key[0] else 1)
        contents = np.bincount(group[fresh], minlength=int(group[-1]) + 1) if fresh.any() else np.zeros(int(group[-1]) + 1, int)
        if same_key[0]:
            before = 2 if several else 1
            if waiting is not None and contents[0]:
                yield out(waiting, np.ones(1, bool), True)
                waiting = None
            contents[0] += before
        if waiting is not None and (not same_key[0] or group[-1] > 0):
            if waiting["looped"][0]:
                yield out(waiting, np.ones(1, bool), True)
            waiting = None
        last = group == group[-1]
        open_single = contents[-1] == 1
        hard = fresh & ((contents[group] > 1) | rows["looped"].astype(bool))
        if open_single and fresh[last].any():
            pick = np.flatnonzero(fresh & last)[:1]
            waiting = {c: v[pick] for c, v in rows.items()}
            hard[pick] = False
        if hard.any():
            yield out(rows, hard, True)
        several = contents[-1] > 1
        head = (key[-1], content[-1], first_doc[-1], first_start[-1])
    if waiting is not None and waiting["looped"][0]:
        yield out(waiting, np.ones(1, bool), True)


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` bytes at least, by doubling."""
    n = len(text)
    padded = np.concatenate([text, np.full(8, 255, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    have = 8
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate([[False], ranked[1:] != ranked[:-1]])
        if have >= depth or fresh.sum() == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(fresh).astype(np.uint64) + np.uint64(1)
        del order, ranked
        key = rank * np.uint64(n + 2)
        key[: max(n - have, 0)] += rank[have:]
        have *= 2


def _expanded(low: np.ndarray, width: np.ndarray, letter: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals of ``cw`` for each interval of a string ``w`` and each byte ``c`` before its suffixes."""
    owner = np.repeat(np.arange(len(width), dtype=np.int32), width)
    at = np.arange(len(owner), dtype=np.int32) + (low - (np.cumsum(width) - width).astype(np.int32))[owner]
    code = owner * np.int32(256) + letter[at] if len(width) < 1 << 23 else owner * np.int64(256) + letter[at]
    del owner
    by = np.argsort(code, kind="stable")
    to, code = step[at[by]], code[by]
    cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return np.minimum.reduceat(to, cut), np.maximum.reduceat(to, cut) + np.int32(1)


def long_prefix_groups(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes, and numbers of the groups that share a prefix of ``length`` or more.

    Common prefixes are derived by increasing value, breadth first: from the interval of each string ``w`` the
    intervals of ``cw`` follow, for the bytes ``c`` before its suffixes (the transform). An interval of a string of ``k + 1`` bytes whose right
    border is not yet known gives that border the value ``k`` and is expanded further; each border is set once. After
    ``length`` rounds the borders still unknown are those whose neighbours share ``length`` bytes or more.
    """
    n = len(text)
    order = sorted_suffixes(text, length + 1).astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    # before the first byte stands the last
    letter, step = text[order - 1], place[order - 1]
    del place
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.asarray([0], np.int32), np.asarray([n], np.int32)
    for _ in range(length):
        width = high - low
        single = width == 1
        new_low = [step[low[single]]]
        new_high = [new_low[0] + np.int32(1)]
        wide_low, wide = low[~single], width[~single]
        # so many bytes at a time, or one interval that is wider
        part = np.cumsum(wide, dtype=np.int64) // EXPANDED
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(wide)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a < b:
                lows, highs = _expanded(wide_low[a:b], wide[a:b], letter, step)
                new_low.append(lows)
                new_high.append(highs)
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        unknown = ~known[high]
        low, high = low[unknown], high[unknown]
        known[high] = True
        if not len(low):
            break
    return order, np.cumsum(known[:n])


def repeated_starts(parts: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (document, start) of the windows of ``length`` bytes of ``parts`` that also start earlier in ``parts``."""
    text = np.frombuffer(b"\xff".join(p[2] for p in parts) + b"\xff", np.uint8)
    sizes = np.asarray([len(p[2]) + 1 for p in parts], np.int32)
    begin = (np.cumsum(sizes) - sizes).astype(np.int32)
    order, group = long_prefix_groups(text, length)
    part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)[order]
    # windows that lie within their part, of groups that hold several
    pick = order - begin[part] + length < sizes[part]
    order, group, part = order[pick], group[pick], part[pick]
    pair = np.flatnonzero(group[1:] == group[:-1])
    pick = np.zeros(len(group), bool)
    pick[pair] = pick[pair + 1] = True
    order, group, part = order[pick], group[pick], part[pick]
    doc = np.asarray([p[0] for p in parts], np.int64)[part]
    start = np.asarray([p[1] for p in parts], np.int64)[part] + (order - begin[part])
    by = np.lexsort((start, doc, group))
    group, doc, start = group[by], doc[by], start[by]
    if not len(group):
        return doc, start
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    again = (doc != doc[head]) | (start != start[head])
    return doc[again], start[again]


def _spans(doc: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)])) if len(doc) else np.empty(0, int)
    last = np.concatenate([cut[1:], [len(doc)]]).astype(int) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[cut]), pa.array(start[cut].astype(np.int32)), pa.array((start[last] - start[cut] + length).astype(np.int32))], names=["doc_id", "start", "size"]
    )


def _transform(length: int):
    """Whole groups, sorted by key, in blocks of bounded size through the transform."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[int, int, bytes]] = []
        held, last = 0, None
        for batch in batches:
            for key, doc, start, raw in zip(*(batch[c].to_pylist() for c in ("key", "doc_id", "start", "raw")), strict=True):
                if key != last and held >= BLOCK_BYTES:
                    yield _spans(*repeated_starts(parts, length), length)
                    parts, held = [], 0
                last = key
                parts.append((doc, start, raw))
                held += len(raw)
        if parts:
            yield _spans(*repeated_starts(parts, length), length)

    return run


def _cut_out(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The bytes of the stretches that go to the transform."""
    keys, docs, starts, raws = [], [], [], []
    for doc, text, parts in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "parts")), strict=True):
        raw = encoded(text)
        for p in parts:
            keys.append(p["key"])
            docs.append(doc)
            starts.append(p["start"])
            raws.append(raw[p["start"] : p["start"] + p["size"]])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(docs, pa.int64()), pa.array(starts, pa.int32()), pa.array(raws, pa.binary())], names=["key", "doc_id", "start", "raw"]
    )


def _single_windows(length: int):
    """Stretches of over-full groups as single windows, keyed by their whole content."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = []
        for doc, text, parts in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "parts")), strict=True):
            prefix = sums(np.frombuffer(encoded(text), np.uint8))
            at = np.concatenate([np.arange(p["start"], min(p["start"] + p["size"], len(prefix) - 1) - length + 1) for p in parts])
            h = span_hash(prefix, at, at + length)
            found.append((h, np.full(len(at), doc, np.int64), at))
        h, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((at, doc, h))
        h, doc, at = h[order], doc[order], at[order]
        fresh = np.concatenate([[True], h[1:] != h[:-1]])
        head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        done = (doc != doc[head]) | (at != at[head])
        spread = mixed(doc.astype(np.uint64) ^ at.astype(np.uint64))
        size = np.full(len(at), length)
        return _rows(np.where(done, spread, h), h, doc, at, size, np.zeros(len(at), bool), done)

    return run


def _met(rows: DataFrame) -> DataFrame:
    dealt = rows.repartition("key").sortWithinPartitions("key", "content", "doc_id", "start")
    return dealt.mapInArrow(_meet, "doc_id long, start int, size int, key long, hard boolean")


def _without(carry: list[str], characters: bool):
    """Each text without the bytes its spans cover, or without the characters they cover as a whole."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, spans, sizes = [], [], []
        for text, parts in zip(batch["text"].to_pylist(), batch["parts"].to_pylist(), strict=True):
            raw = encoded(text)
            runs: list[list[int]] = []
            for start, end in sorted((p["start"], min(p["start"] + p["size"], len(raw))) for p in parts or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                elif end > start:
                    runs.append([start, end])
            if characters:
                runs = [r for r in (_whole(raw, *r) for r in runs) if r[0] < r[1]]
            edges = [0, *(x for r in runs for x in r), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "end": b} for a, b in runs])
            sizes.append(len(raw))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(batch[c] for c in carry), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
            names=["doc_id", *carry, "n_bytes", "spans", "kept"],
        )

    return run


def _whole(raw: bytes, start: int, end: int) -> list[int]:
    """The part of a span that holds whole UTF-8 characters only."""
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return [start, end]


def repeated_spans(
    docs: DataFrame, length: int = 100, most: int = MOST_STRETCHES, carry: tuple[str, ...] = (), most_bytes: int = MOST_BYTES
) -> DataFrame:
    """Stretches ``(doc_id, start, size)`` of bytes whose every ``length``-byte string also starts earlier.

    Earlier is a smaller doc_id, or an earlier start in the same text. Windows are grouped by the least hash of their grams, so
    equal ones always meet. Of stretches of equal content all but the first are covered at once, before and after the
    shuffle, so a passage that a third of all documents share is a row per batch and key. Different stretches of a
    group go through the transform, in blocks of whole groups; a group of over ``most`` different stretches, or of over
    ``most_bytes`` bytes, is split into single windows, which are keyed by their content.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry).where("doc_id is not null")
    met = keep(_met(map_batches(texts.select("doc_id", "text"), _first_of_batch(length), ROWS, 500)), "met")
    hard = met.where("hard")
    full = hard.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).where((F.col("n") > most) | (F.col("bytes") > most_bytes))
    full = keep(full.select("key"), "full")
    marked = hard.join(full.withColumn("full", F.lit(True)), "key", "left")
    by_doc = marked.groupBy("doc_id", F.coalesce("full", F.lit(False)).alias("full")).agg(
        F.collect_list(F.struct("start", "size", "key")).alias("parts")
    )
    with_text = texts.join(by_doc, "doc_id").select("doc_id", "text", "parts", "full")
    cut = map_batches(with_text.where("not full"), _cut_out, "key long, doc_id long, start int, raw binary", 200)
    blocks = cut.repartition("key").sortWithinPartitions("key", "doc_id", "start")
    spans = met.where("not hard").select("doc_id", "start", "size").unionByName(blocks.mapInArrow(_transform(length), SPANS))
    if not full.isEmpty():
        single = map_batches(with_text.where("full"), _single_windows(length), ROWS, 200)
        spans = spans.unionByName(_met(single).where("not hard").select("doc_id", "start", "size"))
    return spans


def drop_repeats(docs: DataFrame, length: int = 100, carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """Every text without the bytes that a ``length``-byte string covers which also starts earlier, judged on the input.

    Works on ``docs (doc_id, text, ...)`` as UTF-8 bytes; matches never cross documents. With ``characters``, a character
    goes only if all of its bytes are covered, so that what is kept is text again. A null text is empty. Rows that share a
    doc_id are places of one document: repeated rows get equal results and do not count as repeats of each other. Rows
    without doc_id are left as they are and are not compared. Returns doc_id, the columns to ``carry``, n_bytes, spans
    (removed runs), kept (bytes).
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry)
    spans = repeated_spans(docs, length, carry=carry)
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "size")).alias("parts"))
    # the same selection of texts as above, so that their one shuffle serves both joins
    placed = texts.where("doc_id is not null").join(by_doc, "doc_id", "left").select("doc_id", "text", *carry, "parts")
    nothing = F.lit(None).cast("array<struct<start:int,size:int>>")
    loose = texts.where("doc_id is null").select("doc_id", "text", *carry, nothing.alias("parts"))
    types = dict(texts.dtypes)
    schema = ", ".join(["doc_id long", *(f"{c} {types[c]}" for c in carry), "n_bytes long, spans array<struct<start:int,end:int>>, kept binary"])
    return map_batches(placed.unionByName(loose), _without(list(carry), characters), schema, 500)
