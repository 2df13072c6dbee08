"""Merkle manifest of a data set, with an octopus multiproof for each partition of its leaves.

Every document is a leaf of its source's tree, every source's root a leaf of the tree above. A node covers up to
``FAN`` nodes below it. Leaves lie in aligned blocks of ``FAN ** BLOCK_LEVELS``; a block gives one node to the next
superstep, so each superstep is one grouping of far fewer rows. For the proofs each block names the nodes its leaves
need and it cannot derive itself, all of them once, fetches them by one join, derives the nodes its leaves share, and
writes out each leaf's proof on the spot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffmill.llm.common import keep

FAN = 3
#: Levels of a block, which makes 2,187 leaves of about 100 bytes.
BLOCK_LEVELS = 7
#: Rows of a fetch that carry a tree's proof in the tree above, and the root, instead of a node.
ABOVE, ROOT = -1, -2


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def size_at(n: int, level: int) -> int:
    """Nodes that a tree of ``n`` leaves has at a level."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """Levels above the leaves; a lone leaf is its own root."""
    level = 0
    while size_at(n, level) > 1:
        level += 1
    return level


def missing(first: int, last: int, n: int) -> Iterator[tuple[int, int]]:
    """Least set of nodes ``(level, idx)`` that the proofs of the leaves from ``first`` to ``last`` need beside them.

    Level by level, the siblings of known nodes that are not known themselves; their parents are known then.
    """
    for level in range(height(n)):
        low, high = first - first % FAN, min(last - last % FAN + FAN, size_at(n, level))
        yield from ((level, i) for i in [*range(low, first), *range(last + 1, high)])
        first, last = first // FAN, last // FAN


def parents(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]


#: One step of a proof: place of the node among its siblings, and the siblings, left to right.
Step = tuple[int, list[str]]


def fold(leaf: str, proof: Iterable[Step]) -> str:
    """The root that a leaf and its proof lead to."""
    for place, siblings in proof:
        leaf = digest("".join([*siblings[:place], leaf, *siblings[place:]]))
    return leaf


def trail(proof: Iterable[Step]) -> str:
    """A proof as text: ``place:sibling.sibling`` per level, joined by commas."""
    return ",".join(f"{place}:{'.'.join(siblings)}" for place, siblings in proof)


def read_trail(text: str) -> list[Step]:
    parts = (step.split(":") for step in text.split(",") if step)
    return [(int(place), siblings.split(".") if siblings else []) for place, siblings in parts]


def framed(*values: Column) -> Column:
    """Values as one text: ``-`` for null, else byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, n, block, idx, leaf and carried columns; ``nodes``: tree, level, idx, leaf (the node's hash) from the
    block's top level on; ``roots``: tree, n and leaf; ``levels``: those of a block."""

    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame
    levels: int


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree, with the task's number and the row's place in its tree there."""
    part, before, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch["tree"].to_numpy(zero_copy_only=False)
        new = np.concatenate([[trees[0] != before], trees[1:] != trees[:-1]])
        starts = np.maximum.accumulate(np.where(new, np.arange(len(trees)), 0))
        rows = np.arange(len(trees)) - starts
        if not new[0]:
            rows[: int(np.argmax(new)) if new.any() else len(trees)] += seen
        before, seen = trees[-1], int(rows[-1]) + 1
        arrays = [*batch.columns, pa.array(np.full(len(trees), part, np.int32)), pa.array(rows.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "part", "row"])


def place(leaves: DataFrame, order: Sequence[str], levels: int) -> DataFrame:
    """``leaves`` (tree, leaf, ...) with ``idx``, the place in their tree by ``order``, nulls first, and then by leaf; ``n``,
    the tree's size; and ``block``.

    Ranges of the sorted leaves number their rows, and the ranges' counts give the offsets, so a tree that holds a third
    of all leaves is spread over many tasks. Leaves that are equal in all of it take any order among themselves.
    """
    kept = keep(leaves, "leaves").withColumn("tie", F.monotonically_increasing_id())
    by = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("leaf"), F.col("tie")]
    ranged = kept.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    numbered = keep(ranged.mapInArrow(_number, f"{schema}, part int, row long"), "numbered")
    ranges = numbered.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    ranges = ranges.select(
        "tree", "part", F.sum("rows").over(tree).alias("n"),
        (F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias("before"),
    )
    placed = numbered.join(ranges, ["tree", "part"]).withColumn("idx", F.col("before") + F.col("row"))
    return placed.withColumn("block", F.floor(F.col("idx") / FAN**levels)).drop("part", "row", "before")


def _climb(level: int, inner: bool, levels: int):
    """The nodes above a block of nodes of ``level``: the topmost one, and with ``inner`` also those between."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree, n, block = (k.as_py() for k in key)
        nodes = [h.hex() for h in table.sort_by("idx")["leaf"].to_pylist()]
        out = []
        for up in range(1, min(levels, height(n) - level) + 1):
            nodes, first = parents(nodes), block * FAN ** (levels - up)
            if inner or len(nodes) == 1:
                out += [(level + up, first + i, h) for i, h in enumerate(nodes)]
        if not out:  # a lone leaf
            out = [(level, 0, nodes[0])]
        heights, places, hashes = zip(*out, strict=True)
        return pa.table({
            "tree": pa.array([tree] * len(out), pa.string()), "n": pa.array([n] * len(out), pa.int64()),
            "level": pa.array(heights, pa.int32()), "idx": pa.array(places, pa.int64()),
            "leaf": pa.array([bytes.fromhex(h) for h in hashes], pa.binary()),
        })

    return run


_NODE = "tree string, n long, level int, idx long, leaf binary"


def build(leaves: DataFrame, order: Sequence[str], name: str, levels: int = BLOCK_LEVELS) -> Manifest:
    """Trees over ``leaves`` (tree, leaf binary, and ``order``). Of the data only the largest tree's size goes to the driver."""
    placed = keep(place(leaves, order, levels), name)
    most = placed.agg(F.max("n")).first()[0] or 0
    groups = ["tree", "n", "block"]
    made = placed.select(*groups, "idx", "leaf").groupBy(*groups).applyInArrow(_climb(0, False, levels), _NODE)
    nodes = keep(made, f"{name}-nodes")
    step = nodes
    for level in range(levels, height(most), levels):
        # nodes of this level in trees that go on above it
        step = step.where((F.col("level") == level) & (F.col("n") > FAN**level))
        step = step.withColumn("block", F.floor(F.col("idx") / FAN**levels)).select(*groups, "idx", "leaf")
        step = keep(step.groupBy(*groups).applyInArrow(_climb(level, True, levels), _NODE), f"{name}-nodes")
        nodes = nodes.unionByName(step)
    # the topmost node of a tree is the only one of its level
    tops = nodes.groupBy("tree", "n").agg(F.max_by("leaf", "level").alias("leaf"))
    return Manifest(placed, nodes.drop("n"), keep(tops, f"{name}-roots"), levels)


def _requests(block_levels: int):
    """The missing nodes of each block."""
    block_size = FAN**block_levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, n, block in zip(*(batch[c].to_pylist() for c in ("tree", "n", "block")), strict=True):
                wanted = list(missing(block * block_size, min((block + 1) * block_size, n) - 1, n))
                if wanted:
                    levels, places = zip(*wanted, strict=True)
                    salts = [block % _salts(k, block_levels) for k in levels]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([tree] * len(wanted), pa.string()), pa.array([block] * len(wanted), pa.int64()),
                            pa.array(levels, pa.int32()), pa.array(places, pa.int64()), pa.array(salts, pa.int32()),
                        ],
                        names=["tree", "block", "level", "idx", "salt"],
                    )

    return run


def _salts(level: int, block_levels: int) -> int:
    """Copies of a node of this level, so that some thousand blocks ask for one copy. A level's nodes fall by the same
    power, so all copies together are far fewer than the blocks."""
    return FAN ** min(max(0, level - 2 * block_levels), 7)


def _fetched(manifest: Manifest) -> DataFrame:
    """The nodes that each block asks for: (tree, block, level, idx, hash)."""
    levels = manifest.levels
    blocks = manifest.leaves.where(F.col("idx") % FAN**levels == 0).select("tree", "n", "block")
    wanted = blocks.mapInArrow(_requests(levels), "tree string, block long, level int, idx long, salt int")
    salts = F.lit(1)
    for level in range(2 * levels + 1, 2 * levels + 8):
        salts = F.when(F.col("level") >= level, _salts(level, levels)).otherwise(salts)
    copies = manifest.nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    found = wanted.join(copies, ["tree", "level", "idx", "salt"])
    return found.select("tree", "block", "level", "idx", F.lower(F.hex("leaf")).alias("hash"))


def _expand(carry: Sequence[str], claimed: str | None, with_trail: bool):
    """Proofs of a block's leaves, from its own nodes and the fetched ones."""

    def run(key: tuple, leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("idx")
        known: dict[tuple[int, int], str] = {}
        above, root = [], None
        for level, idx, value in zip(*(fetched[c].to_pylist() for c in ("level", "idx", "hash")), strict=True):
            if level == ABOVE:
                above = read_trail(value)
            elif level == ROOT:
                root = value
            else:
                known[level, idx] = value
        n, first = leaves["n"][0].as_py(), leaves["idx"][0].as_py()
        nodes = [h.hex() for h in leaves["leaf"].to_pylist()]
        # the shared nodes, from the leaves to the tree's root; an aligned block is whole below its own top
        levels = []
        for level in range(height(n)):
            last = first + len(nodes) - 1
            low, high = first - first % FAN, min(last - last % FAN + FAN, size_at(n, level))
            row = [known[level, i] if i < first or i > last else nodes[i - first] for i in range(low, high)]
            levels.append((low, first, len(nodes), row))
            nodes, first = parents(row), first // FAN
        subroot = nodes[0]
        # proofs from the top down: a node's proof is its siblings and its parent's proof
        proofs: list[tuple[Step, ...]] = [tuple(above)]
        texts = ["".join(s for _, siblings in above for s in siblings)]
        up_first = 0
        for low, first, count, row in reversed(levels):
            next_proofs, next_texts = [], []
            for i in range(first, first + count):
                run_start = i - i % FAN - low
                place_ = i % FAN
                siblings = row[run_start : run_start + place_] + row[run_start + place_ + 1 : run_start + FAN]
                next_proofs.append(((place_, siblings), *proofs[i // FAN - up_first]))
                next_texts.append("".join(siblings) + texts[i // FAN - up_first])
            proofs, texts, up_first = next_proofs, next_texts, first
        own = leaves["leaf"].to_pylist()
        given = leaves[claimed].to_pylist() if claimed else own
        folded = [fold(h.hex(), p) for h, p in zip(given, proofs, strict=True)]
        size = len(own)
        columns = {name: leaves[name] for name in carry}
        columns |= {
            "leaf": pa.array([h.hex() for h in own]), "subroot": pa.array([subroot] * size), "root": pa.array([root] * size, pa.string()),
            "proof_sha256": pa.array([digest(t) for t in texts]), "folded_root": pa.array(folded),
            "verified": pa.array([f == (root or subroot) for f in folded]),
        }
        if with_trail:
            columns["proof"] = pa.array([trail(p) for p in proofs])
        return pa.table(columns)

    return run


def prove(
    manifest: Manifest, carry: Sequence[str] = ("tree",), claimed: str | None = None, above: DataFrame | None = None,
    with_trail: bool = False,
) -> DataFrame:
    """One row per leaf: the carried columns, leaf, subroot, root, proof_sha256, folded_root, verified, and with
    ``with_trail`` the proof as text.

    ``above`` (tree, proof, root) goes on from the tree's root to one above; without it the tree's root is the root.
    ``claimed`` names a column with the leaf that is folded instead of the true one.
    """
    blocks = ["tree", "block"]
    fetched = _fetched(manifest)
    if above is not None:
        tops = manifest.leaves.where(F.col("idx") % FAN**manifest.levels == 0).select(*blocks).join(above, "tree")
        lines = F.array(
            F.struct(F.lit(ABOVE).alias("level"), F.lit(0).cast("long").alias("idx"), F.col("proof").alias("hash")),
            F.struct(F.lit(ROOT).alias("level"), F.lit(0).cast("long").alias("idx"), F.col("root").alias("hash")),
        )
        fetched = fetched.unionByName(tops.select(*blocks, F.inline(lines)))
    types = dict(manifest.leaves.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in carry])
    schema += ", leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    columns = list(dict.fromkeys([*blocks, "n", "idx", "leaf", *carry, *([claimed] if claimed else [])]))
    return manifest.leaves.select(*columns).groupBy(*blocks).cogroup(fetched.groupBy(*blocks)).applyInArrow(
        _expand(carry, claimed, with_trail), schema + (", proof string" if with_trail else "")
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """Leaves of documents: tree (null sources first, then by their bytes), doc_id, leaf, and ``claimed``, the leaf with
    another text."""

    def leaf(text: Column) -> Column:
        return F.unhex(F.sha2(framed(*[F.col(c) for c in FIELDS[:-1]], text), 256))

    text = F.col("text")
    changed = text if changed_text is None else changed_text
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf(text).alias("leaf"),
        F.when(changed.eqNullSafe(text), None).otherwise(leaf(changed)).alias("claimed"),
    ).withColumn("claimed", F.coalesce("claimed", "leaf"))


def document_manifest(
    docs: DataFrame, changed_text: Column | None = None, with_trail: bool = False, levels: int = BLOCK_LEVELS
) -> DataFrame:
    """Leaf, subroot, root and checked proof of each document.

    Null values are marked as such, so a null and an empty text are different leaves, as are a null and an empty source,
    which have trees of their own. Rows with the same doc_id are leaves of their own, ordered by their hash; equal rows
    have equal leaves and neighbouring places. Other columns have no part in it. No documents give no rows.
    """
    manifest = build(document_leaves(docs, changed_text), ["doc_id"], "merkle", levels)
    tops = manifest.roots.select(F.lit("all").alias("tree"), F.col("tree").alias("below"), "leaf")
    upper = prove(build(tops, ["below"], "merkle-top", levels), ["below"], with_trail=True)
    above = upper.select(F.col("below").alias("tree"), "proof", F.col("subroot").alias("root"))
    return prove(manifest, ["tree", "doc_id"], "claimed", keep(above, "merkle-above"), with_trail)
