"""Line dedup against plain dictionaries, over insertions and deletions."""

import random

import numpy as np
from llm_rows import ODD, frame

from tariffmill.llm import linededup as L

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain(held, judged):
    """(doc_id, n_lines, n_dropped, kept) of judged rows, given all rows that the index holds."""
    first, last = {}, {}
    for d, text in held:
        for line in (text or "").split("\n"):
            k, d_ = key(line), L.NO_DOC if d is None else d
            first[k], last[k] = min(first.get(k, d_), d_), max(last.get(k, d_), d_)
    out = []
    for d, text in judged:
        lines, d_ = (text or "").split("\n"), L.NO_DOC if d is None else d
        kept = [x for x in lines if not (len(key(x)) >= 10 and key(x) in first and first[key(x)] < last[key(x)] and d_ > first[key(x)])]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept).encode()))
    return sorted(out, key=repr)


def got(index, docs, batch=None):
    return sorted((tuple(r) for r in L.drop_shared_lines(index, docs, batch).collect()), key=repr)


def texts(seed, ids):
    rng = random.Random(seed)
    pool = [f"common line number {i}" for i in range(8)] + ["short", "", "  Common LINE number 1\t", "ÄÖÜ äöü lin", "ÄÖÜ äöü li"]
    return [(i, "\n".join([rng.choice(pool) if rng.random() < 0.7 else f"own line {i} {rng.random()}" for _ in range(rng.randrange(9))])) for i in ids]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_one_batch_with_odd_rows(spark):
    rows = texts(1, range(100, 160)) + ODD + [(7, "one line of its own"), (7, "one line of its own"), (8, None), (300, "é" * 12), (301, "É" * 12)]
    rows += [(i, "the line that is in each of them\nit holds more than a third") for i in range(400, 500)]
    docs = frame(spark, rows).withColumnRenamed("kept", "hi").withColumnRenamed("parts", "dropped")
    index, batch = L.insert(None, docs)
    assert got(index, docs, batch) == plain(rows, rows)
    assert got(index, docs) == plain(rows, rows)


def test_insertions_and_deletions_can_be_undone(spark):
    a, b, c = texts(2, range(0, 90, 3)), texts(3, range(1, 90, 3)), texts(4, range(2, 90, 3))
    da, db, dc = (docs_of(spark, x) for x in (a, b, c))
    one, _ = L.insert(L.empty_index(spark, 4), da)
    two, batch = L.insert(one, db)
    assert got(two, db, batch) == plain(a + b, b)
    assert got(two, da) == plain(a + b, a)
    three, _ = L.insert(two, dc)
    gone = [(i,) for i in range(0, 45)] + [(9999,), (None,)]
    four = L.delete(three, spark.createDataFrame(gone, "doc_id long"))
    left = [r for r in a + b + c if r[0] >= 45]
    assert got(four, docs_of(spark, left)) == plain(left, left)
    back, _ = L.insert(four, docs_of(spark, [r for r in a + b + c if r[0] < 45]))
    assert got(back, da.unionByName(db).unionByName(dc)) == plain(a + b + c, a + b + c)
    # the index before is still there, and an index without documents holds no fingerprint
    assert got(two, da) == plain(a + b, a)
    none = L.delete(four, docs_of(spark, left).select("doc_id"))
    held = [L.CuckooFilter.from_bytes(bytes(r[0])) for r in none.filters.select("filter").collect()]
    assert sum(np.count_nonzero(layer) for f in held for layer in f.layers) == 0
    assert got(none, da) == plain([], a)


def test_filter_spares_look_ups(spark):
    rows = [(i, "\n".join(f"line {i} {j} of its own" for j in range(20)) + "\nshared by all of them") for i in range(200)]
    index, batch = L.insert(None, docs_of(spark, rows))
    held = [r["held"] for r in L.probe(index, batch.keys).collect()]
    assert len(held) == 4001 and sum(h > 1 for h in held) < 20 and min(held) >= 1


def test_empty_table(spark):
    docs = docs_of(spark, [])
    index, batch = L.insert(None, docs)
    assert got(index, docs, batch) == []


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 3000):
        keys = rng.integers(-(2**63), 2**63 - 1, n)
        f = L.CuckooFilter.for_keys(n)
        f.add(np.repeat(keys, 2))
        more = rng.integers(-(2**63), 2**63 - 1, 2 * n)
        f.add(more)
        f = L.CuckooFilter.from_bytes(f.to_bytes())
        assert (f.count(keys) >= 2).all() and (f.count(more) >= 1).all()
        assert (f.count(rng.integers(-(2**63), 2**63 - 1, 10_000)) > 0).mean() < 0.005
        f.remove(keys)
        assert (f.count(keys) >= 1).all() and (f.count(more) >= 1).all()
        f.remove(np.concatenate([keys, more]))
        assert sum(np.count_nonzero(x) for x in f.layers) == 0
