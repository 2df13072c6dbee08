"""The manifest against a plain tree built in memory."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from llm_rows import ODD, frame
from pyspark.sql import functions as F

from tariffmill.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def framed(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h("".join(row[i : i + 3])) for i in range(0, len(row), 3)])
    return levels


def plain_proof(levels, i):
    steps = []
    for row in levels[:-1]:
        low = i - i % 3
        steps.append((i % 3, row[low:i] + row[i + 1 : low + 3]))
        i //= 3
    return steps


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, proof) of rows (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(((row[0] is not None, row[0] or 0), h(framed(*row)), row[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: plain_tree([leaf for _, leaf, _ in sorted(trees[s])]) for s in names}
    top = plain_tree([built[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, leaf, doc_id) in enumerate(sorted(trees[s])):
            steps = plain_proof(built[s], i) + plain_proof(top, at)
            joined = "".join(x for _, siblings in steps for x in siblings)
            out.append((doc_id, leaf, built[s][-1][0], top[-1][0], h(joined), merkle.trail(steps)))
    return out


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("levels", [1, 7])
@pytest.mark.parametrize("sizes", [[1], [1, 2, 3], [0, 30, 9, 10, 100, 27, 1, 28]])
def test_equal_to_a_plain_tree(spark, sizes, levels):
    rows = []
    for s, size in enumerate(sizes):
        source = None if s == 4 else ["b", "", "ä", "z"][s % 4] * (1 + s // 4)
        rows += [(1000 * s + i, source, "en", i, f"text {i}\nof {s}") for i in range(size)]
    random.Random(3).shuffle(rows)
    got = merkle.document_manifest(docs_of(spark, rows), with_trail=True, levels=levels)
    got = got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "proof", "folded_root", "verified").collect()
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted(plain(rows), key=key)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)
    assert all(merkle.fold(r["leaf"], merkle.read_trail(r["proof"])) == r["root"] for r in got)


def test_changed_texts_are_found(spark):
    rows = [(i, "s", "en", 1, "a\nb" if i % 3 else "ab") for i in range(40)] + [(99, "s", "en", 1, None)]
    got = merkle.document_manifest(docs_of(spark, rows), F.replace("text", F.lit("\n"), F.lit("")), levels=1).collect()
    assert {r["doc_id"]: r["verified"] for r in got} == {i: i % 3 == 0 for i in range(40)} | {99: True}
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in got)


def test_odd_rows_and_an_empty_table(spark):
    wide = frame(spark, ODD).withColumn("tree", F.lit("x")).withColumn("leaf", F.lit(1)).withColumn("idx", F.lit("y"))
    got = merkle.document_manifest(wide, levels=1).collect()
    expected = plain([(d, "s", "en", 0, t) for d, t in ODD])
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["root"], r["proof_sha256"]) for r in got)
    assert found == sorted((d is not None, d or 0, leaf, root, proof) for d, leaf, _, root, proof, _ in expected)
    assert merkle.document_manifest(wide.limit(0)).collect() == []


def test_missing_is_least():
    for n in (1, 5, 27, 30, 100):
        levels = plain_tree([str(i) for i in range(n)])
        for first in range(0, n, 4):
            for last in range(first, min(first + 9, n)):
                known, wanted = set(range(first, last + 1)), set()
                for level, row in enumerate(levels[:-1]):
                    kin = {j for i in known for j in range(i - i % 3, min(i - i % 3 + 3, len(row)))}
                    wanted |= {(level, j) for j in kin - known}
                    known = {i // 3 for i in known}
                got = list(merkle.missing(first, last, n))
                assert set(got) == wanted and len(got) == len(wanted)
