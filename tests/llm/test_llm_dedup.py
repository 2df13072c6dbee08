"""Near duplicates, repeated passages and near passages against brute force, and their behaviour on odd rows."""

import inspect
import itertools
import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import ODD, frame
from tariffmill.llm import compact, minhash, suffix
from tariffmill.llm.common import components

def words_of(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def edited(rng, words, share):
    return [f"e{rng.randrange(99)}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    docs, n = [], 0
    for _ in range(25):
        base = words_of(rng, rng.choice((6, 40, 120, 300)))
        for share in (0, 0, 0.01, 0.03, 0.05, 0.08):
            docs.append((n, " ".join(edited(rng, base, share))))
            n += 1
    passage = words_of(rng, 80)
    for _ in range(20):
        docs.append((n, " ".join(words_of(rng, 60) + edited(rng, passage, 0.01) + words_of(rng, 60))))
        n += 1
    rng.shuffle(docs)
    return docs


def shingle_sets(docs, size):
    out = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        out[d] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    return out


def groups_of(links, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_superminhash_estimates_with_low_variance():
    rng = np.random.default_rng(2)
    seen = []
    for _ in range(150):
        x = rng.integers(0, 2**63, 60).astype(np.uint64)
        y = np.concatenate([x[:45], rng.integers(0, 2**63, 15).astype(np.uint64)])
        s = minhash.superminhash(np.concatenate([x, y]), np.repeat([0, 1], 60), 2, 160)
        seen.append((s[0] == s[1]).mean())
    assert abs(np.mean(seen) - 0.6) < 0.01
    assert np.std(seen) < (0.6 * 0.4 / 160) ** 0.5


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, corpus, size):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, corpus), size=size).collect()}
    sets = shingle_sets(corpus, size)
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = groups_of(links, ids)
    assert {d: got[d]["component_id"] for d in ids} == want
    assert all(got[d]["n_shingles"] == len(sets[d]) and got[d]["kept"] == (want[d] == d) for d in ids)


def test_links_across_groups_need_few_signature_places():
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"])]
    lows = [bytes(160), bytes([1] * 56 + [0] * 104)]  # 65 % agree
    keys = [[7, *range(100 * i, 100 * i + 31)] for i in (1, 2)]
    batch = pa.RecordBatch.from_pylist(
        [
            {"key": 7, "chunk": 0, "block": 0, "own": own, "doc_id": d, "component": d, "n": 96, "keys": keys[i], "main": 1, "low": lows[i], "text": texts[i]}
            for i, (own, d) in enumerate([(True, 2), (False, 1)])
        ]
    )
    least = inspect.signature(minhash.near_duplicates).parameters["least"].default
    got = [b.to_pylist() for b in minhash._close(32, 160, 5, 80, least)(iter([batch]))]
    assert got == [[{"a": 2, "b": 1}]]


def test_near_duplicates_on_odd_rows(spark):
    rows = [tuple(r) for r in minhash.near_duplicates(frame(spark, ODD), size=2).collect()]
    assert len(rows) == len(ODD)
    got = {r[0]: r[1:] for r in rows if r[0] is not None}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert [got[d][1] for d in (4, 5, 6)] == [4, 4, 4]
    assert sorted(r[1:] for r in rows if r[0] is None) == [(0, None, True), (5, None, True)]
    assert got[9] == (1, 8, False) and got[11][0] == 1
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 7), (200, 201), (300, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {**dict.fromkeys([*range(51), 100], 0), 200: 200, 201: 200}
    assert components(df.limit(0)).count() == 0


def removed(docs, length):
    seen, out = set(), {}
    for d, raw in sorted(docs):
        hit = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                hit[i : i + length] = b"\1" * length
            seen.add(w)
        out[d] = bytes(c for c, h in zip(raw, hit, strict=True) if not h)
    return out


@pytest.mark.parametrize(("most", "most_bytes"), [(4000, 1 << 24), (2, 1 << 24), (4_000, 2_000)])
def test_repeats_equal_brute_force(spark, monkeypatch, most, most_bytes):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdé ") for _ in range(400))
    docs = []
    for d in range(60):
        own = "".join(rng.choice("ab") for _ in range(rng.choice((0, 5, 99, 100, 300))))
        i = rng.randrange(250)
        docs.append((d, own + rng.choice(("", shared[i : i + 140], "xyz" * 60, "q" * 130)) + own[:50]))
    monkeypatch.setattr(suffix.repeated_spans, "__defaults__", (100, most, (), most_bytes))
    got = {r["doc_id"]: r for r in suffix.drop_repeats(frame(spark, docs), 100).collect()}
    want = removed([(d, t.encode()) for d, t in docs], 100)
    assert {d: bytes(r["kept"]) for d, r in got.items()} == want
    assert all(r["n_bytes"] - len(r["kept"]) == sum(s["end"] - s["start"] for s in r["spans"]) for r in got.values())


def test_repeats_on_odd_rows(spark):
    got = [tuple(r) for r in suffix.drop_repeats(frame(spark, ODD), 100).collect()]
    assert len(got) == len(ODD)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[1][1:] == (0, [], bytearray()) and by_id[10][1] == 600 and len(by_id[10][3]) == 2
    assert len(by_id[8][3]) == 1  # a run of one letter: all windows but the first start later, and cover all but its first byte
    assert len(by_id[9][3]) == 0
    assert suffix.drop_repeats(frame(spark, []), 100).count() == 0
    kept = suffix.drop_repeats(frame(spark, [(1, "é" * 300), (2, "a" + "é" * 300)]), 101, characters=True).collect()
    assert all(bytes(r["kept"]).decode() is not None for r in kept)


def test_compact_windows_equal_brute_force():
    rng = np.random.default_rng(4)
    for n, least, top in ((40, 5, 2**60), (90, 12, 2**60), (60, 6, 12)):
        h = rng.integers(0, top, n).astype(np.uint64)
        want = set()
        for m in range(n):
            left, right = m, m
            while left and h[left - 1] > h[m]:
                left -= 1
            while right < n - 1 and h[right + 1] >= h[m]:
                right += 1
            if right - left + 1 >= least:
                want.add((left, m, right))
        assert set(zip(*(x.tolist() for x in compact.compact_windows(h, least)), strict=True)) == want


def shared_linked(docs, sets):
    """For each repeat of fifty words whether its documents are in one group."""
    seen, out = {}, []
    for d, t in docs:
        w = t.split()
        for i in range(len(w) - 49):
            first = seen.setdefault(tuple(w[i : i + 50]), d)
            if first != d:
                out.append(sets[first] == sets[d])
    return out


def test_near_passages_link_every_exact_passage(spark):
    rng = random.Random(21)
    passages = [words_of(rng, n, 5000) for n in (50, 55, 70, 120, 400)]
    docs = []
    for d in range(150):
        w = words_of(rng, rng.randrange(80), 5000)
        for p in rng.sample(passages, rng.randrange(3)):
            w += p + words_of(rng, rng.randrange(60), 5000)
        docs.append((d, " ".join(w)))
    rows = compact.near_passages(frame(spark, docs)).collect()
    linked = shared_linked(docs, groups_of([(r["doc_id"], r["other_id"]) for r in rows], [d for d, _ in docs]))
    assert linked and all(linked)


def test_near_passages_link_exact_passages_of_common_sentences(spark):
    """Pairs share sixty words that are two of twelve sentences, which nearly all other documents hold as well."""
    rng = random.Random(8)
    common = [words_of(rng, 30, 4000) for _ in range(12)]
    orders = [(i, j) for i in range(12) for j in range(12) if i != j]
    rng.shuffle(orders)
    docs, planted = [], []
    for d in range(400):
        w = []
        for i in rng.sample(range(12), 3):
            w += words_of(rng, rng.randrange(3, 30), 4000) + common[i] + words_of(rng, rng.randrange(3, 30), 4000)
        docs.append((d, " ".join(w)))
    for k, (i, j) in enumerate(orders[:40]):
        for d in (1000 + k, 2000 + k):
            docs.append((d, " ".join(words_of(rng, 20, 4000) + common[i] + common[j] + words_of(rng, 20, 4000) + rng.choice(common))))
        planted.append((1000 + k, 2000 + k))
    rows = compact.near_passages(frame(spark, docs)).collect()
    sets = groups_of([(r["doc_id"], r["other_id"]) for r in rows], [d for d, _ in docs])
    assert all(sets[a] == sets[b] for a, b in planted)
    linked = shared_linked(docs, sets)
    assert linked and all(linked)
    # a sentence of thirty words alone links nothing
    assert not any(r["doc_id"] < 1000 and r["other_id"] < 1000 for r in rows)


def test_near_passages_link_variants_of_common_sentences(spark):
    """Pairs share two of twelve common sentences but for a word between them, so that the first documents of all their keys hold
    something else and no run of fifty words is equal."""
    rng = random.Random(9)
    common = [words_of(rng, 30, 4000) for _ in range(12)]
    orders = [(i, j) for i in range(12) for j in range(12) if i != j]
    rng.shuffle(orders)
    docs, planted = [], []
    for d in range(300):
        w = []
        for i in rng.sample(range(12), 3):
            w += words_of(rng, rng.randrange(20, 30), 4000) + common[i] + words_of(rng, rng.randrange(20, 30), 4000)
        docs.append((d, " ".join(w)))
    for k, (i, j) in enumerate(orders[:40]):
        for d, first in ((1000 + k, common[j][0]), (2000 + k, f"edit{k}")):
            docs.append((d, " ".join(words_of(rng, 20, 4000) + common[i] + [first] + common[j][1:] + words_of(rng, 20, 4000))))
        planted.append((1000 + k, 2000 + k))
    rows = compact.near_passages(frame(spark, docs)).collect()
    sets = groups_of([(r["doc_id"], r["other_id"]) for r in rows], [d for d, _ in docs])
    assert sum(sets[a] == sets[b] for a, b in planted) >= 0.9 * len(planted)
    assert not any(r["doc_id"] < 1000 and r["other_id"] < 1000 for r in rows)


def test_stretches_of_large_groups_meet_in_parts(spark, monkeypatch):
    """All pairs of different groups meet, once each, however the stretches of a key are dealt."""
    monkeypatch.setattr(compact, "HELD", 3)
    monkeypatch.setattr(compact, "STREAMED", 7)
    rng = random.Random(2)
    rows = [(key, d, 0, 0, min(rng.randrange(9), 5)) for key in (1, 2) for d in range(40)]
    grouped = spark.createDataFrame(rows, "key long, doc_id long, s int, e int, group long")
    sketches = spark.createDataFrame([(d, d, 0, 0, 46, bytearray(b"\xff" * 128)) for d in range(40)], "content long, doc_id long, s int, e int, least_different int, sketch binary")
    got = [(r["a"], r["b"]) for r in compact._alike_pairs(grouped, sketches, 46, 0.8).collect()]
    want = {(a, b) for k, a, _, _, g in rows for l, b, _, _, h in rows if k == l and a < b and g != h}
    assert len(got) == len(want) and set(got) == want


def repetitive_parts(seed, n):
    rng = random.Random(seed)
    phrase = bytes(rng.choices(range(97, 122), k=300))
    pieces = lambda: (phrase[: rng.randrange(150, 300)] if rng.random() < 0.7 else bytes(rng.choices(range(97, 122), k=50)) for _ in range(30))
    return [(d, rng.randrange(50), b"".join(pieces())[:4000]) for d in range(n)]


def test_transform_memory_in_proportion_to_a_large_block():
    """A block of a large group takes under 80 bytes a byte at most, so that one of ``MOST_BYTES`` fits beside another."""
    parts = repetitive_parts(3, 250)
    tracemalloc.start()
    try:
        doc, _ = suffix.repeated_starts(parts, 100)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(doc) > 100_000 and peak < 80 * sum(len(p[2]) for p in parts)


def test_intervals_expanded_in_parts_give_the_same_places(monkeypatch):
    parts = repetitive_parts(4, 6)
    monkeypatch.setattr(suffix, "EXPANDED", 300)
    doc, start = suffix.repeated_starts(parts, 100)
    seen, want = set(), set()
    for d, s, raw in parts:
        for i in range(len(raw) - 99):
            (want.add((d, s + i)) if raw[i : i + 100] in seen else seen.add(raw[i : i + 100]))
    assert want and set(zip(doc.tolist(), start.tolist(), strict=True)) == want


def test_all_stretches_of_a_large_key_are_compared(spark):
    """Variants of one passage, of which few are alike: whatever two stretches of a key hold similar passages, their documents come
    together, in keys of many stretches too."""
    rng = random.Random(12)
    base, docs = words_of(rng, 60, 10**6), []
    for family in range(150):
        own = list(base)
        for at in rng.sample(range(2, 58), 2):
            own[at] = f"family{family}"
        for member in range(2):
            w = list(own)
            w[rng.randrange(2, 58)] = f"member{family}x{member}"
            docs.append((2 * family + member, " ".join(words_of(rng, 20, 10**6) + w + words_of(rng, 20, 10**6))))
    texts = [t.encode().split() for _, t in docs]
    key, doc, s, e = (x.tolist() for x in compact.text_stretches([d for d, _ in docs], texts, 5, 46, 3, 2))
    shingles = dict(zip([d for d, _ in docs], compact._sequences(iter(texts), 5), strict=True))
    met = {}
    for k, d, low, high in zip(key, doc, s, e, strict=True):
        met.setdefault(k, []).append((d, shingles[d][low : high + 46]))
    alike = set()
    for rows in met.values():
        for (a, x), (b, y) in itertools.combinations(sorted(rows, key=lambda r: r[0]), 2):
            if a // 2 == b // 2 and a < b and compact.verified(x, y, 46, 0.8):
                alike.add((a, b))
    assert max(len(rows) for rows in met.values()) > compact.FEW and len(alike) > 50
    sets = groups_of([(r["doc_id"], r["other_id"]) for r in compact.near_passages(frame(spark, docs)).collect()], [d for d, _ in docs])
    assert [(a, b) for a, b in sorted(alike) if sets[a] != sets[b]] == []


def test_pairs_looked_at_together_are_those_verified():
    rng = np.random.default_rng(1)
    x, before, y = [], [], []
    for _ in range(300):
        vocabulary = rng.integers(1, 2**62, rng.integers(20, 120)).astype(np.uint64)
        g = rng.choice(vocabulary, rng.integers(46, 240)) if rng.random() < 0.5 else vocabulary
        other = g.copy()
        for at in rng.integers(0, len(g), rng.integers(0, 6)).tolist():
            other[at : at + int(rng.integers(1, 8))] = rng.integers(1, 2**62)
        seen, last = {}, []
        for at, v in enumerate(g.tolist()):
            last.append(seen.get(v, -1))
            seen[v] = at
        x.append(g)
        before.append(np.asarray(last, np.int32))
        y.append(other[rng.integers(0, 8) :])
    want = [k for k in range(300) if compact.verified(x[k], y[k], 46, 0.8)]
    assert 20 < len(want) < 280
    assert sorted(compact._alike_sequences(x, before, y, [np.sort(v) for v in y], 46, 0.8)) == want


def test_pieces_of_large_groups_give_few_pairs(spark):
    """Of a narrow key each piece meets two others at most, and only where signatures agree; the groups still come together."""
    n, length = 500, compact.NARROW_BANDS * compact.NARROW_WIDTH
    rows = [(7, d, 3, 5, d, bytearray([1] * length)) for d in range(n)]
    rows += [(7, 2 * n, 0, 1, 2 * n, bytearray(range(2, 2 + length)))]
    pieces = spark.createDataFrame(rows, "key long, doc_id long, s int, e int, group long, signature binary")
    got = compact._near_pieces(pieces, 46).collect()
    assert len(got) <= 2 * n and all(r["a"] < r["b"] for r in got)
    groups = groups_of([(r["a"], r["b"]) for r in got], [*range(n), 2 * n])
    assert {groups[d] for d in range(n)} == {0} and groups[2 * n] == 2 * n


def test_pieces_of_a_key_stay_in_one_task(spark):
    """The join below becomes a broadcast as it runs; pieces of a key that lie in several input partitions still meet."""
    length = compact.NARROW_BANDS * compact.NARROW_WIDTH
    rows = [(key, 10 * key + d, 3, 5, 10 * key + d, bytearray([d] + [1] * (length - 1))) for d in range(6) for key in range(300)]
    rows += [(1000 + k, 10**6 + k, 3, 5, 10**6 + k, bytearray([1] * length)) for k in range(2000)]
    pieces = spark.createDataFrame(rows, "key long, doc_id long, s int, e int, group long, signature binary").repartition(16, "doc_id")
    whole = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(whole, "false")
    try:
        pairs = {(r["a"], r["b"]) for r in compact._near_pieces(pieces, 46).collect()}
    finally:
        spark.conf.unset(whole)
    assert pairs == {(10 * key + i, 10 * key + j) for key in range(300) for j in range(1, 6) for i in {0, j - 1}}


def test_links_of_a_document_leave_its_task_as_one(spark, tmp_path, monkeypatch):
    """Of twenty links of each document nearly all are contracted before the first join, however many tasks there are."""
    from tariffmill.llm import common

    written = []
    real = common.keep
    monkeypatch.setattr(common, "keep", lambda df, name="part": written.append(real(df, name)) or written[-1])
    links = [(a, b, 1.0) for b in range(100, 1100) for a in range(20)]
    whole = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(whole, "false")
    try:
        groups = compact._groups(spark.createDataFrame(links, "doc_id long, other_id long, similarity double").repartition(64)).collect()
    finally:
        spark.conf.unset(whole)
    groups = {r["node"]: r["component"] for r in groups}
    assert groups == {d: 0 for d in [*range(20), *range(100, 1100)]}
    assert written[0].count() <= 1000 + 20 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_run_hashes_and_counts_equal_brute_force():
    rng = np.random.default_rng(4)
    for n, values, least in ((60, 4, 5), (200, 30, 46), (46, 3, 46), (90, 2**62, 7), (9, 2, 1)):
        g = rng.integers(0, values, n).astype(np.uint64)
        runs = [tuple(g[i : i + least].tolist()) for i in range(n - least + 1)]
        hashes = compact._run_hashes(g, least).tolist()
        assert len(set(hashes)) == len(set(runs)) == len(set(zip(hashes, runs, strict=True)))
        assert compact._different(g, least).tolist() == [len(set(r)) for r in runs]


def test_pieces_equal_brute_force():
    g = np.random.default_rng(3).integers(0, 2**63, 200).astype(np.uint64)
    at = np.concatenate([np.arange(5, 40), np.arange(60, 90)])
    low = np.asarray([(g[i : i + 46] * compact._FACTORS[:, None]).min(1) for i in at])
    got = list(zip(*compact._pieces(g, at, 46), strict=True))
    assert sum(int(last - first) + 1 for _, first, last, _ in got) == len(at) * compact.NARROW_BANDS
    want = {}
    for band in range(compact.NARROW_BANDS):
        own = low[:, band * compact.NARROW_WIDTH : (band + 1) * compact.NARROW_WIDTH]
        for place, hashes in zip(at.tolist(), own.tolist(), strict=True):
            want.setdefault((band, *hashes), []).append(place)
    assert len({int(key) for key, *_ in got}) == len(want)
    for _, first, last, signature in got:
        middle = (np.searchsorted(at, first) + np.searchsorted(at, last)) // 2
        byte = low[middle].astype(np.uint8)
        assert any((np.roll(byte, -(band + 1) * compact.NARROW_WIDTH) == signature).all() for band in range(compact.NARROW_BANDS))
        assert [*range(first, last + 1)] in [[p for p in places if first <= p <= last] for places in want.values()]


def test_wide_rows_go_to_python_in_batches_of_bounded_bytes(spark):
    from tariffmill.llm.common import BATCH_BYTES, keep

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    wide = spark.range(3000, numPartitions=1).selectExpr("repeat('x', 10000) AS text")
    assert max(r["n"] for r in keep(wide.mapInArrow(sizes, "n long")).collect()) < 2 * BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_op8_lists_every_document_of_a_passage(spark, tmp_path):
    from tariffmill.llm import queries

    rng = random.Random(4)
    passage = words_of(rng, 60, 5000)
    docs = [(d, " ".join(words_of(rng, 20, 5000) + passage + words_of(rng, 20, 5000))) for d in range(12)]
    docs += [(20 + d, " ".join(words_of(rng, 90, 5000))) for d in range(5)] + [(30, docs[0][1])]
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op8_substring_dedup"](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == {*range(12), 30}
    texts = {d: t.split() for d, t in docs}
    for r in rows:
        assert texts[r["doc_id"]][r["start"] : r["end"]] == texts[r["other_id"]][r["other_start"] : r["other_end"]]
    links = {(r["kind"], r["doc_id"], r["start"], r["other_id"], r["other_start"]) for r in rows}
    assert links == {(kind, other, at, doc, start) for kind, doc, start, other, at in links}


def test_open_runs_of_rows_that_share_an_id(spark):
    """A longer and a shorter text of one doc_id: places in the one may lie behind the end of the other."""
    rng = random.Random(6)
    phrase = words_of(rng, 30, 4000)
    around = lambda n: words_of(rng, n, 10**6)
    docs = [(1, " ".join(around(300) + phrase + around(60))), (1, " ".join(phrase + around(40)))]
    docs += [(d, " ".join(around(40) + phrase + around(40))) for d in range(2, 12)]
    assert compact.near_passages(frame(spark, docs)).collect() == []


def test_near_passages_recall_and_stretches(spark):
    """Passages edited to a similarity of 0.8 to 0.85, each pair with words of its own: nine in ten are linked at least."""
    rng = random.Random(5)
    docs, pairs = [], []
    for k in range(150):
        p = words_of(rng, 120, 10**6)
        q = list(p)
        for at in rng.sample(range(5, 115, 10), 2):
            q[at] = f"edit{k}"
        x, y = ({tuple(v[i : i + 5]) for i in range(116)} for v in (p, q))
        if 0.8 <= len(x & y) / len(x | y) <= 0.87:
            docs += [(2 * k, " ".join(words_of(rng, 40, 10**6) + p)), (2 * k + 1, " ".join(q + words_of(rng, 30, 10**6)))]
            pairs.append((2 * k, 2 * k + 1))
    found = {(r["doc_id"], r["other_id"]) for r in compact.near_passages(frame(spark, docs)).collect()}
    assert len(pairs) > 50 and sum(p in found for p in pairs) >= 0.9 * len(pairs) and found <= set(pairs)


def test_stretches_equal_brute_force():
    rng = np.random.default_rng(6)
    least = 5
    texts = [rng.integers(1, 30, n).astype(np.uint64) for n in (5, 40, 9, 23)]
    g = np.concatenate([x for t in texts for x in (t, np.zeros(1, np.uint64))])
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    hashes = []
    for f in (1, 2):
        h = compact.mixed(g ^ np.uint64(f)) | np.uint64(1)
        h[ends] = 0
        hashes.append(h)
    key, first, last = compact.stretches(hashes, least)
    got = {int(i): int(k) for k, s, e in zip(key, first, last, strict=True) for i in range(s, e + 1) if not (ends[(ends >= i)][:1] < i + least).any()}
    want = {}
    for i in range(len(g) - least + 1):
        if not any(i <= e < i + least for e in ends):
            k = np.zeros(1, np.uint64)
            for h in hashes:
                k = compact.mixed(k ^ h[i : i + least].min())
            want[i] = int(k[0])
    assert got == want


def test_near_passages_link_edited_passages(spark, corpus):
    rows = compact.near_passages(frame(spark, corpus)).collect()
    sets = groups_of([(r["doc_id"], r["other_id"]) for r in rows], [d for d, _ in corpus])
    # copies with edits of their own: all that share fifty words are linked
    linked = shared_linked(corpus, sets)
    assert all(linked)
    texts = {d: t.split() for d, t in corpus}
    for r in rows:
        a, b = (texts[r[k]][r[s] : r[e]] for k, s, e in (("doc_id", "start", "end"), ("other_id", "other_start", "other_end")))
        x, y = ({tuple(v[i : i + 5]) for i in range(len(v) - 4)} for v in (a, b))
        assert r["kind"] == "copy" or len(x & y) / len(x | y) >= 0.8
    # a passage in twenty documents gives some pairs for each, not one for every two
    per_pair = defaultdict(int)
    for r in rows:
        per_pair[r["doc_id"], r["other_id"]] += 1
    assert len(per_pair) < 6 * len(corpus)


def test_near_passages_on_odd_rows(spark):
    rows = compact.near_passages(frame(spark, ODD)).collect()
    assert all(r["doc_id"] is not None for r in rows)
    assert compact.near_passages(frame(spark, [])).count() == 0
