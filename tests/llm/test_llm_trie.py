"""The trie against a plain dictionary of prefixes."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest

from tariffmill.llm import prefixtrie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(convs):
    """Rows of COLUMNS for {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((own[0], len(node), parent, len(own), children[node], leaves[node], saved[node], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def turns_of(spark, convs, shuffle=True):
    rows = [(c, i, r, t, "x", 3) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, base int")


def got(trie):
    return sorted((tuple(r) for r in trie.select(*COLUMNS).collect()), key=repr)


def family(seed, count, deep=6, words=2):
    rng = random.Random(seed)
    return {
        c: [("user" if i % 2 else "bot", "é" * rng.randrange(1, words + 1)) for i in range(rng.randrange(1, deep + 1))] for c in range(count)
    }


@pytest.mark.parametrize("range_turns", [3, 20, 100_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_plain_prefixes(spark, seed, range_turns):
    convs = family(seed, 60 * seed, deep=5 + 3 * seed)
    trie = T.prefix_trie(T.sequences(turns_of(spark, convs)), range_turns=range_turns)
    assert got(trie) == plain(convs)


def test_copies_chains_and_ranges(spark):
    """A group of copies, one long conversation, and a prefix that spans all ranges."""
    same = [("user", "hello"), ("bot", "good day")]
    convs = {c: same for c in range(0, 400, 2)}
    convs |= {c: [*same, ("user", f"question {c}"), ("bot", "ok")] for c in range(1, 99, 2)}
    convs |= {1000: [("user", "x" * 40)] * 300, 1001: [("user", "x" * 40)] * 200, 1002: [("user", "x" * 40)]}
    assert got(T.prefix_trie(T.sequences(turns_of(spark, convs)), range_turns=40)) == plain(convs)


def test_id_text_in_pieces(spark, monkeypatch):
    ids = [5, 10, 200, 3000, 40000]
    paths = [b"a"] * 3 + [b"b"] * 2
    import pyarrow as pa

    monkeypatch.setattr(T, "CHUNK", 2)
    batch = pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(ids)], names=["path", "conv_id"])
    rows = [r for b in T._hashed(T._chunks(iter([batch.slice(0, 1), batch.slice(1)]))) for r in b.to_pylist()]
    want = [(5, 3, "5,10,200"), (3000, 2, "3000,40000")]
    assert [(r["first"], r["n"], r["ends"]) for r in rows] == [(f, n, sha256(t.encode()).hexdigest()) for f, n, t in want]


def test_odd_turns(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "second"), (1, 0, "a", None), (2, 1, "", ""), (2, 1, "", ""), (None, 1, "user", "lost"),
        (3, 5, "u" * 10, "x" * 100_000), (-7, 1, "user", "first"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = got(T.prefix_trie(T.sequences(turns, near=5)))
    tied = sorted([("", "second"), ("a", "")], key=lambda x: __import__("hashlib").md5(f"{len(x[0])}:{x[0]}{x[1]}".encode()).digest())
    convs = {1: [("user", "first"), *tied], 2: [("", "")] * 2, 3: [("u" * 10, "x" * 100_000)], -7: [("user", "first")]}
    assert out == plain(convs)


def test_turnless_conversations_and_none(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert got(T.prefix_trie(T.sequences(empty))) == []
    steps = "conv_id long, steps array<struct<hash:binary,size:int>>"
    trie = T.prefix_trie(spark.createDataFrame([(4, []), (2, []), (3, [(bytearray(b"x" * 16), 7)])], steps))
    ends = [sha256(x).hexdigest() for x in (b"2,4", b"3")]
    assert got(trie) == sorted([(2, 0, None, 3, 1, 1, 0, ends[0]), (3, 1, 2, 1, 0, 1, 0, ends[1])], key=repr)
