"""Prefix trie of conversations, from the common prefixes of neighbours in sorted order.

A conversation is the sequence of its turns' hashes. Distinct sequences are sorted over ranges; each range joins
neighbours by union-find, the longest common prefix first, and every merge makes a branching node, or adds to the one of
the same depth. Nodes that no other range can share are finished there. The others lie on the paths of a range's first
and last sequence, down to what these share with the neighbouring ranges: these contracted paths alone are merged, by
one aggregate, and go back to their ranges, which then give out all nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffmill.llm.common import keep

#: Bytes of a turn's hash (MD5).
STEP = 16
#: Turns that a range of sorted sequences holds on average.
RANGE_TURNS = 100_000
#: Ids of members in one row of text on the way to their hash.
CHUNK = 50_000
NO_ENDS = sha256(b"").hexdigest()


def sequences(turns: DataFrame, near: int = 1) -> DataFrame:
    """One row per conversation (conv_id, base, steps): its turns' hashes and text sizes, ordered by turn, nulls first.

    A missing role or text is empty; turns of the same number are ordered by their hash. Turns without a conv_id belong to
    no conversation. A turn enters the row as 28 bytes, its text does not. ``near`` conversations, ids from a multiple of
    it on (``base``), come to the same task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    rows = turns.where("conv_id is not null").select(
        conv.alias("conv_id"), (conv - conv % near).alias("base"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("hash"),
            F.octet_length(text).alias("size"),
        ).alias("step"),
    )
    steps = F.sort_array(F.collect_list("step"))
    return rows.repartition("base").groupBy("base", "conv_id").agg(steps.alias("steps")).select("conv_id", "base", "steps")


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from their start."""
    low, high = 0, min(len(a), len(b)) // STEP
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * STEP : mid * STEP] == b[low * STEP : mid * STEP]:
            low = mid
        else:
            high = mid - 1
    return low


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by path and conv_id, as pieces of the text of each path's ids."""
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, ids = batch["path"].to_pylist(), batch["conv_id"].to_pylist()
        starts = [i for i in range(len(ids)) if i == 0 or paths[i] != paths[i - 1] or i % CHUNK == 0]
        ends = [*starts[1:], len(ids)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([paths[i] for i in starts], pa.binary()), pa.array([ids[i] for i in starts], pa.int64()),
                pa.array([e - i for i, e in zip(starts, ends, strict=True)], pa.int64()),
                pa.array([",".join(map(str, ids[i:e])) for i, e in zip(starts, ends, strict=True)]),
            ],
            names=["path", "first", "n", "ids"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by path and first id, as one row per path with the hash of the whole text; one piece is held."""
    now, digest, first, n = None, None, 0, 0
    for batch in batches:
        out = []
        for path, start, count, ids in zip(*(batch[c].to_pylist() for c in ("path", "first", "n", "ids")), strict=True):
            if path != now:
                if now is not None:
                    out.append((first, n, digest.hexdigest()))
                now, digest, first, n = path, sha256(ids.encode()), start, count
            else:
                digest.update(b"," + ids.encode())
                n += count
        if out:
            yield _end_rows(out)
    if now is not None:
        yield _end_rows([(first, n, digest.hexdigest())])


def _end_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    first, n, ends = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(n, pa.int64()), pa.array(ends)], names=["first", "n", "ends"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted sequences with the task's number, the place there, and what they share with the one before (first: 0)."""
    part, before, at = TaskContext.get().partitionId(), b"", 0
    for batch in batches:
        shared = []
        for seq in batch["seq"].to_pylist():
            shared.append(common(before, seq))
            before = seq
        rows = np.arange(at, at + len(shared))
        at += len(shared)
        arrays = [*batch.columns, pa.array([part] * len(shared), pa.int32()), pa.array(rows), pa.array(shared, pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "part", "row", "lcp"])


def _boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        last, start = batch["last"].to_pylist(), batch["start"].to_pylist()
        shared = [-1 if b is None else common(a, b) for a, b in zip(last, start, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["part"], batch["next"], pa.array(shared, pa.int32())], names=["part", "next", "shared"]
        )


def merge_neighbours(lengths: list[int], lcps: list[int]) -> tuple[list[int], list[int]]:
    """Depths and parents of the compact trie over sorted distinct sequences, whose own nodes come first.

    Edges between neighbours are taken by descending depth. A component's top node is deeper than the edge, or the left
    one's lies at its depth: then it takes the right one's top as a further child.
    """
    depth, parent = list(lengths), [-1] * len(lengths)
    top, up = list(range(len(lengths))), list(range(len(lengths)))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for i in sorted(range(1, len(lengths)), key=lambda i: -lcps[i]):
        a, b = find(i - 1), find(i)
        node = top[a]
        if depth[node] != lcps[i]:
            parent[node] = len(depth)
            node = len(depth)
            depth.append(lcps[i])
            parent.append(-1)
        parent[top[b]] = node
        up[b], top[a] = a, node
    return depth, parent


class Range:
    """The trie of one range of sorted sequences, with what its members add to each node.

    ``left`` and ``right`` are the depths that its first and last sequence share with the ranges before and behind, -1
    without one. A node down to these depths is open: other ranges have members of it too. The first of them owns it.
    """

    def __init__(self, table: pa.Table, left: int, right: int) -> None:
        table = table.sort_by("row")
        self.left, self.right, self.size = left, right, table.num_rows
        self.seqs = table["seq"].to_pylist()
        self.ends = table["ends"].to_pylist()
        sizes = table["sizes"].to_pylist()
        self.cum = [np.concatenate([[0], np.cumsum(s, dtype=np.int64)]) for s in sizes]
        lengths = [len(s) // STEP for s in self.seqs]
        self.depth, self.parent = merge_neighbours(lengths, table["lcp"].to_pylist())
        count, nodes = len(self.depth), range(len(self.depth))
        own = self.size
        self.n = [*table["n"].to_pylist(), *[0] * (count - own)]
        self.first = [*table["first"].to_pylist(), *[None] * (count - own)]
        self.low = [*range(own), *[own] * (count - own)]
        self.high = [*range(own), *[-1] * (count - own)]
        self.children, self.leaves, self.saved = [0] * count, [0] * count, [0] * count
        self.order = sorted(nodes, key=lambda v: -self.depth[v])
        for v in self.order:
            if v < own and not self.leaves[v] and not (v == own - 1 and right == lengths[v]) and not self.children[v]:
                self.leaves[v] = 1
            p = self.parent[v]
            if p >= 0:
                up = self.depth[p] + 1
                self.n[p] += self.n[v]
                self.first[p] = self.first[v] if self.first[p] is None else min(self.first[p], self.first[v])
                self.low[p], self.high[p] = min(self.low[p], self.low[v]), max(self.high[p], self.high[v])
                self.children[p] += not self.open_left(v, up)
                self.leaves[p] += self.leaves[v]
                self.saved[p] += self.saved_at(v, up)
        self.left_paths, self.right_paths = self._paths(self.seqs[0], left), self._paths(self.seqs[-1], right)

    @staticmethod
    def _paths(seq: bytes, to: int) -> list[bytes]:
        """Hashes of a sequence's prefixes down to a depth."""
        h, out = blake2b(digest_size=16), []
        for d in range(to + 1):
            h.update(seq[(d - 1) * STEP : d * STEP] if d else b"")
            out.append(h.copy().digest())
        return out

    def open_left(self, v: int, d: int) -> bool:
        return d <= self.left and self.low[v] == 0

    def chain(self, v: int) -> tuple[int, int]:
        """Depths of the nodes from below the parent down to ``v``, which have the same members."""
        return (self.depth[self.parent[v]] + 1 if self.parent[v] >= 0 else 0), self.depth[v]

    def open_to(self, v: int) -> int:
        return max(self.left if self.low[v] == 0 else -1, self.right if self.high[v] == self.size - 1 else -1)

    def path(self, v: int, d: int) -> bytes:
        return self.left_paths[d] if self.open_left(v, d) else self.right_paths[d]

    def saved_at(self, v: int, d: int) -> int:
        """What the subtree of the chain's node of depth ``d`` saves, by these members; a node counts once as kept, at
        its owner."""
        cum, up = self.cum[min(self.low[v], self.size - 1)], max(d - 1, 0)
        total = self.saved[v] + (self.n[v] - 1) * int(cum[self.depth[v]] - cum[up])
        if self.open_left(v, d):
            total += int(cum[min(self.depth[v], self.left)] - cum[up])
        return total


_SPINE = (
    "part int, left int, right int, depth int, path binary, n long, first long, children long, leaves long, saved long, ends string"
)


def _edges(table: pa.Table) -> tuple[int, int]:
    return (table["left"][0].as_py(), table["right"][0].as_py()) if table.num_rows else (-1, -1)


def _contracted(key: tuple, rows: pa.Table, edges: pa.Table) -> pa.Table:
    """The open nodes of a range, with what its members add to them."""
    left, right = _edges(edges)
    r = Range(rows, left, right)
    out = []
    for v in r.order:
        low, high = r.chain(v)
        for d in range(low, min(high, r.open_to(v)) + 1):
            children = r.children[v] if d == high else int(not r.open_left(v, d + 1))
            ends = r.ends[v] if d == high and v < r.size else None
            out.append((d, r.path(v, d), r.n[v], r.first[v], children, r.leaves[v], r.saved_at(v, d), ends))
    depth, path, n, first, children, leaves, saved, ends = zip(*out, strict=True) if out else ([],) * 8
    same = pa.array([key[0].as_py()] * len(out), pa.int32())
    return pa.table({
        "part": same, "left": pa.array([left] * len(out), pa.int32()), "right": pa.array([right] * len(out), pa.int32()),
        "depth": pa.array(depth, pa.int32()), "path": pa.array(path, pa.binary()), "n": pa.array(n, pa.int64()),
        "first": pa.array(first, pa.int64()), "children": pa.array(children, pa.int64()), "leaves": pa.array(leaves, pa.int64()),
        "saved": pa.array(saved, pa.int64()), "ends": pa.array(ends, pa.string()),
    })


_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


def _given_out(key: tuple, rows: pa.Table, merged: pa.Table) -> pa.Table:
    """All nodes that a range owns; open ones with the merged values."""
    r = Range(rows, *_edges(merged))
    whole = {m["path"]: m for m in merged.to_pylist()}
    cols: list[list] = [[] for _ in range(8)]
    conv, depth, parent, n, children, leaves, saved, ends = cols

    def first_of(v: int, d: int) -> int:
        return whole[r.path(v, d)]["first"] if d <= r.open_to(v) else r.first[v]

    for v in r.order:
        low, high = r.chain(v)
        end = r.ends[v] if v < r.size else NO_ENDS
        bound = min(high, r.open_to(v))
        for d in range(low, high + 1):
            if d > bound and d > low:
                break
            if r.open_left(v, d):
                continue
            above = None if d == 0 else first_of(v, d - 1) if d > low else first_of(r.parent[v], d - 1)
            if d <= bound:
                m = whole[r.path(v, d)]
                row = (m["first"], d, above, m["n"], m["children"], m["leaves"], m["saved"], m["ends"] or NO_ENDS)
            else:
                row = (r.first[v], d, above, r.n[v], r.children[v] if d == high else 1, r.leaves[v], r.saved_at(v, d), end if d == high else NO_ENDS)
            for column, value in zip(cols, row, strict=True):
                column.append(value)
        # the rest of the chain is closed and has one parent after the other with the same members
        start = max(bound, low) + 1
        if (k := high - start + 1) > 0:
            conv += [r.first[v]] * k
            depth += range(start, high + 1)
            parent += [first_of(v, start - 1), *[r.first[v]] * (k - 1)]
            n += [r.n[v]] * k
            children += [*[1] * (k - 1), r.children[v]]
            leaves += [r.leaves[v]] * k
            saved += [r.saved[v]] * k if r.n[v] == 1 else [r.saved_at(v, d) for d in range(start, high + 1)]
            ends += [*[NO_ENDS] * (k - 1), end]
    names = [f.split()[0] for f in _NODES.split(", ")]
    types = [*[pa.int64()] * 7, pa.string()]
    return pa.table({name: pa.array(c, t) for name, c, t in zip(names, cols, types, strict=True)})


def prefix_trie(convs: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """All nodes of the trie over conversations (conv_id, steps: array of hash, size), one row per distinct prefix.

    ``conv_id`` is the smallest member; also depth, the parent's conv_id, members, children, childless nodes of the
    subtree, what its nodes save (members but one, times the size of the last turn), and the hash of the ids of the members
    that end there. No conversations give no node. Equal conversations meet as rows of 24 bytes, sorted over ranges; only the
    text of their ids, which a hash must read in order, passes one task, in pieces.
    """
    rows = convs.select(
        "conv_id", F.unhex(F.array_join(F.transform("steps", lambda s: F.hex(s["hash"])), "")).alias("seq"),
        F.transform("steps", lambda s: s["size"]).alias("sizes"),
    )
    rows = keep(rows, "trie-rows")
    ids = keep(rows.select("conv_id", F.unhex(F.md5("seq")).alias("path")), "trie-ids")
    pieces = ids.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = pieces.mapInArrow(_chunks, "path binary, first long, n long, ids string")
    ends = pieces.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_hashed, "first long, n long, ends string")
    distinct = keep(rows.join(ends, F.col("conv_id") == F.col("first")).drop("conv_id"), "trie-distinct")
    turns = distinct.agg(F.sum(F.size("sizes"))).first()[0] or 0
    ranged = distinct.repartitionByRange(max(1, int(turns) // range_turns + 1), "seq").sortWithinPartitions("seq")
    schema = "seq binary, sizes array<int>, first long, n long, ends string, part int, row long, lcp int"
    ordered = keep(ranged.select("seq", "sizes", "first", "n", "ends").mapInArrow(_numbered, schema), "trie-sorted")

    spans = ordered.groupBy("part").agg(F.min("seq").alias("start"), F.max("seq").alias("last"))
    # one narrow row per range
    follow = spans.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"))
    pairs = spans.select("part", "last").join(follow, "part").join(
        spans.select(F.col("part").alias("next"), "start"), "next", "left"
    )
    shared = keep(pairs.select("part", "next", "last", "start").mapInArrow(_boundaries, "part int, next int, shared int"), "trie-edges")
    before = shared.where("next is not null").select(F.col("next").alias("part"), F.col("shared").alias("left"))
    edges = shared.select("part", F.col("shared").alias("right")).join(before, "part", "left")
    edges = edges.select("part", F.coalesce("left", F.lit(-1)).alias("left"), "right")

    spines = keep(ordered.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(_contracted, _SPINE), "trie-spines")
    merged = spines.groupBy("depth", "path").agg(
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.min("first").alias("first"), F.max("ends").alias("ends")
    )
    back = spines.select("part", "left", "right", "depth", "path").join(merged, ["depth", "path"])
    back = back.select("part", "left", "right", "path", "n", "first", "children", "leaves", "saved", "ends")
    return ordered.groupBy("part").cogroup(back.groupBy("part")).applyInArrow(_given_out, _NODES)
