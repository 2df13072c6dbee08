"""Mixtures, packing and the pipeline."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from llm_rows import ODD, frame
from tariffmill.llm import mixing, packing
from tariffmill.llm.queries import mix_rows, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def divide(total, children):
    """Whole-number shares by weight, none above its room, by filling children one at a time."""
    shares, left = {}, dict(children)
    while left:
        weight = sum(w for w, _ in left.values())
        over = [n for n, (w, room) in left.items() if w and room * weight <= w * total]
        if not over:
            return shares | {n: w * total // weight if weight else 0 for n, (w, _) in left.items()}
        n = min(over, key=lambda k: (left[k][1] / left[k][0], k))
        shares[n] = left[n][1]
        total -= left.pop(n)[1]
    return shares


def test_budgets_equal_filling_by_hand(spark):
    rng = random.Random(4)
    tokens = {(d, lang, s): rng.choice((0, 5, 300, 4000, 90_000)) for d in "abc" for lang in ("en", "de") for s in ("s1", "s2", "s3")}
    weights = {"domain": {"a": 7, "b": 2, "c": 1}, "language": {"en": 3, "de": 1}, "origin": {"s1": 5}}
    df = spark.createDataFrame([(*k, v) for k, v in tokens.items()], "domain string, language string, origin string, tokens long")
    got = {tuple(r[:3]): r["budget"] for r in mixing.budgets(df, 90, 2, weights, {"domain": 1, "language": 1, "origin": 1}).collect()}
    room = {k: 2 * v for k, v in tokens.items()}
    inner = lambda *p: sum(v for k, v in room.items() if k[: len(p)] == p)
    top = divide(sum(tokens.values()) * 90 // 100, {d: (weights["domain"][d], inner(d)) for d in "abc"})
    for d in "abc":
        low = divide(top[d], {x: (weights["language"][x], inner(d, x)) for x in ("en", "de")})
        for x in ("en", "de"):
            want = divide(low[x], {s: (weights["origin"].get(s, 1), room[d, x, s]) for s in ("s1", "s2", "s3")})
            assert {s: got[d, x, s] for s in want} == want


def test_choice_is_a_prefix_of_epochs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    rng = random.Random(1)
    rows = [(i, "d", "en", f"s{i % 3}", rng.randrange(40)) for i in range(300)] + [(None, None, None, None, 3), (None, None, None, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, domain string, language string, origin string, n_tokens long")
    weights = {"domain": {"": 1, "d": 50}, "origin": {"s0": 20}}
    got = mixing.choose(df, percent=70, max_epochs=3, weights=weights).collect()
    by_leaf = defaultdict(list)
    for r in got:
        by_leaf[r["origin"]].append(r)
    whole = {s: sum(x[4] for x in rows if (x[3] or "") == s) for s in ("", "s0", "s1", "s2")}
    for s, own in by_leaf.items():
        own.sort(key=lambda r: (r["epoch"], r["place"]))
        at = 0
        for r in own:
            assert r["place"] == at or r["n_tokens"] == 0
            at = max(at, r["place"] + r["n_tokens"])
        assert at <= own[0]["budget"]
        assert {r["epoch"] for r in own} == set(range(max(r["epoch"] for r in own) + 1))
        if whole[s] > 50:
            assert own[0]["budget"] - at < 40
    assert max(r["epoch"] for r in by_leaf["s0"]) >= 1
    assert mixing.choose(df.limit(0)).count() == 0
    assert mix_rows(frame(spark, ODD)).count() == len(ODD)


def test_lower_bound_and_best_fit():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 101, 200)
        bins, offsets, fills = packing.best_fit_decreasing(sizes, 100)
        bound = packing.lower_bound(np.bincount(sizes, minlength=101), 100)
        assert bound <= len(fills) <= 1.1 * bound + 1 and fills.max() <= 100
        for b in range(len(fills)):
            at = np.argsort(offsets[bins == b])
            assert np.array_equal(np.cumsum(sizes[bins == b][at])[:-1], offsets[bins == b][at][1:])
    assert packing.lower_bound(np.bincount([51] * 7, minlength=101), 100) == 7
    assert packing.lower_bound(np.bincount([34] * 6, minlength=101), 100) == 3


def group(sizes):
    import pandas as pd

    return pd.DataFrame({"doc_id": range(len(sizes)), "piece": 0, "length": sizes, "g": 0})


def test_the_bound_decides_what_is_repacked():
    run = packing._pack_group(100)
    # no bin is full, but three bins are certified: two are settled, one stays open for others
    sure = run(group([34, 34] * 3))
    assert sure["over_bound"].eq(0).all() and sure[sure["settled"]]["bin"].nunique() == 2
    # a bin more than the bound: bins with a bin's room together are opened, the fuller ones are settled
    gap = run(group([56, *[44] * 8, *[38] * 3, *[24] * 3, *[20] * 4, 16]))
    fills = gap.groupby("bin")["length"].sum()
    opened = fills[sorted(set(gap[~gap["settled"]]["bin"]))]
    assert gap["over_bound"].eq(1).all() and (100 - opened).sum() >= 100 > (100 - opened.sort_values(ascending=False)[1:]).sum()
    assert opened.max() <= fills[sorted(set(gap[gap["settled"]]["bin"]))].min()


def sequences(rows, capacity):
    own = defaultdict(list)
    for r in rows:
        own[r["sequence_id"]].append(r)
    for items in own.values():
        items.sort(key=lambda r: r["offset"])
        at = 0
        for r in items:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return own


def test_exchange_lowers_the_bins(spark):
    """Small groups alone leave a bin open each; exchanged, all pieces take few more bins than their volume."""
    rng = np.random.default_rng(11)
    for sizes in (rng.integers(1, 100, 900), rng.choice([34, 35, 30], 700), np.full(500, 51), rng.integers(20, 60, 800)):
        rows = spark.createDataFrame([(i, 0, int(n)) for i, n in enumerate(sizes)], "doc_id long, piece int, length long")
        got = packing.pack(rows, capacity=100, group_rows=100).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(len(sizes)))
        bins = len(sequences(got, 100))
        bound = packing.lower_bound(np.bincount(sizes, minlength=101), 100)
        assert bound <= bins <= 1.05 * bound + 1


@pytest.mark.parametrize("text", ["", "a", " a", "a  b", "a b ", "x<|endoftext|> y", "é z 12 it's", "\n\n a\tb", "x" * 5000, "a\x00 b", " "])
def test_tokens_equal_the_tokenizer(text):
    known = packing.TokenBytes(tokenizer_path())
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(known(text), "<u4").tolist() == want


def test_tokens_of_many_texts_equal_the_tokenizer():
    """Punctuation, contractions, white space, control characters and added tokens in any order."""
    from tokenizers import Tokenizer

    rng, exact = random.Random(9), Tokenizer.from_file(tokenizer_path())
    bits = ["a", "Don", "'s", "'", '"', "...", "\n", "\n\n", "\t", "é", "12", "<|endoftext|>", "--", "(", "x" * 70, "\x01", "ll", "'ll"]
    texts = [" ".join("".join(rng.choice(bits) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(12))) for _ in range(600)]
    known = packing.TokenBytes(tokenizer_path())
    assert known.encode is not known.exact
    for text in texts:
        assert np.frombuffer(known(text), "<u4").tolist() == exact.encode(text, add_special_tokens=False).ids, text


def test_packing_odd_rows(spark):
    got = packing.pack_documents(frame(spark, ODD), tokenizer_path(), capacity=64, group_rows=3).collect()
    own = defaultdict(list)
    for r in got:
        own[r["sequence_id"]].append(r)
    for rows in own.values():
        rows.sort(key=lambda r: r["offset"])
        at = 0
        for r in rows:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert all((r["length"], r["ids_crc32"]) == (1, zlib.crc32(np.asarray([2], "<u4").tobytes())) for r in empty) and len(empty) == 2
    assert packing.pack_documents(frame(spark, []), tokenizer_path()).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = set(before)
    for _name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, SMALL))
        assert docs.columns == corpus_pipeline.COLUMNS
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert set(rows) <= kept and all(r["n_chars"] == len(r["text"]) for r in rows.values())
        kept = set(rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r["doc_id"] for r in packed} == kept
    # an input without rows passes through all stages
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _name, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.keep(stage(spark, empty, SMALL))
        assert empty.count() == 0
