"""Toxicity scores: a learned lexicon as a trie, met by Levenshtein automata; windows around each hit tell quotation from abuse."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmill.llm.common import keep, map_batches

#: The bound of what is learned from: labelled rows.
MAX_ROWS = 30_000
STEM = range(4, 9)
QUOTES = "\"'“”„«»‹›‘’`"
OPENERS, CLOSERS = set("“„«‹‘"), set("”»›’")
WINDOW = 6
EDIT_LOSS = 0.85
FEATURES = ["strongest", "direct", "quoted", "rate", "window", "cues"]
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W_]+")


def allowed_edits(length: int) -> int:
    """How many misspelled letters still count: none in short terms, whose neighbours are other words."""
    return 0 if length < 5 else 1 if length < 8 else 2


class Matcher:
    """Levenshtein automata of all terms at once, intersected with the trie of the terms.

    A state of the automaton is a set of (trie node, edits so far); states and steps are built when first met and
    kept, so a word costs one table look-up per letter, and most words reach the empty state after a few letters. A term
    ending in ``*`` is a stem: whatever follows it is free.
    """

    limit = 200_000

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, int, bool]]] = [[]]
        self.room = [0]  # the most edits that any term below a node allows
        for term in terms:
            stem = term.endswith("*")
            letters = term.rstrip("*")
            edits = min(allowed_edits(len(letters)), 1) if stem else allowed_edits(len(letters))
            node, path = 0, [0]
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.room.append(0)
                node = self.children[node][c]
                path.append(node)
            self.ends[node].append((term, edits, stem))
            for x in path:
                self.room[x] = max(self.room[x], edits)
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[list[tuple[int, str, bool]]] = []
        self._state(set())  # number 0: nothing is within reach any more
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set) -> int:
        """The state's number, after adding what skipping letters of the terms reaches."""
        best: dict[int, int] = {}
        stack = list(pairs)
        while stack:
            node, e = stack.pop()
            if e > self.room[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            stack += ((x, e + 1) for x in self.children[node].values())
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.found.append([(e, term, stem) for node, e in key for term, most, stem in self.ends[node] if e <= most])
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        to = self.steps[state].get(c)
        if to is None:
            pairs = set()
            for node, e in self.sets[state]:
                if c in self.children[node]:
                    pairs.add((self.children[node][c], e))
                pairs.add((node, e + 1))  # a letter too many
                pairs.update((x, e + 1) for x in self.children[node].values())  # another letter
            to = self.steps[state][c] = self._state(pairs)
        return to

    def alive(self, beginning: str) -> bool:
        """False if no word that begins so is within reach of a term."""
        state = self.start
        for c in beginning:
            state = self._step(state, c)
            if self.found[state] or not state:
                break
        return state != 0

    def match(self, word: str) -> list[tuple[str, int]]:
        """All terms the word is within reach of, with the fewest edits each."""
        if len(self.sets) > self.limit:
            self._reset()
        state, best, steps, step = self.start, {}, self.steps, self._step
        for c in word:
            to = steps[state].get(c)
            state = step(state, c) if to is None else to
            if not state:
                break
            for e, term, stem in self.found[state]:
                if stem and e < best.get(term, 99):
                    best[term] = e
        else:
            for e, term, _ in self.found[state]:
                best[term] = min(e, best.get(term, 99))
        return list(best.items())


def bare(token: str) -> str:
    """A token without what is no letter or digit at its ends, in lower case."""
    if not (token[:1].isalnum() and token[-1:].isalnum()):
        token = _EDGE.sub("", token)
    return token.lower()


@dataclass
class Model:
    """All that scoring needs; small by the bounds above, so it travels with the tasks."""

    terms: dict[str, float] = field(default_factory=dict)
    harmless: frozenset = frozenset()
    cues: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    intercept: float = -2.0


class Scorer(dict):
    """One model's matcher, and how strongly each token seen so far points to abuse, up to a fixed number of tokens."""

    limit, head = 500_000, 5

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.matcher = matcher_of(model.terms) if model.terms else None
        self.dead: set[str] = set()

    def __missing__(self, token: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = self._strength(token)
        return value

    def _strength(self, token: str) -> float:
        """A token's best term's weight, less for each edit; 0 if none. Beginnings that reach no term are remembered."""
        word = bare(token)
        if word[: self.head] in self.dead and word.isalnum():
            return 0.0
        candidates = [word]
        if not word.isalnum():
            candidates += [w for w in _INNER.findall(word) if len(w) >= 4]
        best = 0.0
        for w in candidates:
            found = self.matcher.match(w) if w else ()
            if found and w not in self.model.harmless:
                for term, edits in found:
                    best = max(best, self.model.terms[term] * EDIT_LOSS**edits)
        if not best and len(word) >= self.head and not self.matcher.alive(word[: self.head]):
            if len(self.dead) >= self.limit:
                self.dead.clear()
            self.dead.add(word[: self.head])
        return best

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, float]]]:
        tokens = (text or "").split()
        if self.matcher is None:
            return tokens, []
        strengths = list(map(self.__getitem__, tokens))
        return tokens, [(i, s) for i, s in enumerate(strengths) if s] if any(strengths) else []

    def features(self, text: str | None) -> list[float]:
        """The document's vector: strongest hit, sums over direct and over quoted hits, hits per word, the densest
        window, and the cue words around hits."""
        tokens, found = self.hits(text)
        if not found:
            return [0.0] * len(FEATURES)
        quoted = quoted_positions(tokens, found)
        at = [i for i, _ in found]
        direct = sum(s for (_, s), q in zip(found, quoted, strict=True) if not q)
        inside = sum(s for (_, s), q in zip(found, quoted, strict=True) if q)
        dense, lo = 0, 0
        for hi in range(len(at)):
            while at[hi] - at[lo] > 2 * WINDOW:
                lo += 1
            dense = max(dense, hi - lo + 1)
        cue = [
            self.model.cues.get(bare(w), 0.0) for i in at if self.model.cues for w in tokens[max(0, i - WINDOW) : i + WINDOW + 1]
        ]
        strongest = max(s * (0.5 if q else 1.0) for (_, s), q in zip(found, quoted, strict=True))
        return [
            strongest, math.log1p(direct), math.log1p(inside), math.log1p(100 * len(found) / len(tokens)),
            math.log(dense), sum(cue) / len(cue) if cue else 0.0,
        ]

    def score(self, text: str | None) -> float:
        z = self.model.intercept + sum(a * b for a, b in zip(self.model.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


_KEPT: dict[str, tuple[str, object]] = {}


def _reused(kind: str, parts: object, make):
    """What ``make`` gives, kept by the Python worker for its next tasks as long as it is made of the same parts."""
    key = hashlib.sha256(repr(parts).encode()).hexdigest()
    if _KEPT.get(kind, ("",))[0] != key:
        _KEPT[kind] = (key, make())
    return _KEPT[kind][1]


def matcher_of(terms: dict[str, float]) -> Matcher:
    """The matcher of these terms, with the states that earlier tasks of this worker met."""
    return _reused("matcher", sorted(terms), lambda: Matcher(dict(terms)))


def scorer_of(model: Model) -> Scorer:
    """The model's scorer, with the tokens that earlier tasks of this worker met; these depend on terms and harmless words."""
    scorer = _reused("scorer", (sorted(model.terms.items()), sorted(model.harmless)), lambda: Scorer(model))
    scorer.model = model
    return scorer


def quoted_positions(tokens: list[str], found: list[tuple[int, float]]) -> list[bool]:
    """Which hits stand within quotation marks: marked themselves on both sides, or between an opening and a closing
    mark at most ``WINDOW`` tokens away on either side."""
    out = []
    for i, _ in found:
        left = any(t[:1] in QUOTES for t in tokens[max(0, i - WINDOW) : i + 1])
        shut = any(t.rstrip(".,;:!?)")[-1:] in QUOTES for t in tokens[max(0, i - WINDOW) : i])
        right = any(t.rstrip(".,;:!?)")[-1:] in QUOTES for t in tokens[i : i + WINDOW + 1])
        own = tokens[i][:1] in QUOTES and tokens[i].rstrip(".,;:!?)")[-1:] in QUOTES
        out.append(own or (left and right and not shut))
    return out


def _word_counts(rows: DataFrame) -> DataFrame:
    """Per word, in how many texts with and without the label it occurs; texts of one task are counted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                counts[label].update({bare(t) for t in (text or "").split()})
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict(
            {"word": words, "neg": pa.array([counts[0][w] for w in words], pa.int64()), "pos": pa.array([counts[1][w] for w in words], pa.int64())}
        )

    return rows.mapInArrow(run, "word string, neg long, pos long").where("word <> ''").groupBy("word").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos")
    )


def _lexicon(counts: DataFrame, n_pos: int, n_neg: int, least: int) -> dict[str, float]:
    """Words and stems that are far likelier in labelled texts (log odds over 2.5, stems over 4.5), beyond chance: all that the evidence holds for.

    Stems are beginnings shared by several words whose texts are labelled almost throughout; words that a stem
    of the lexicon covers, and stems within a shorter stem, are left out.
    """
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / (n_neg + 1.0))
    # log-likelihood ratio against chance: among very many words, some rare ones meet only labelled texts by luck
    both = F.col("pos") + F.col("neg")
    gain = F.col("pos") * F.log(F.col("pos") * (n_pos + n_neg) / (both * n_pos)) + F.when(
        F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") * (n_pos + n_neg) / (both * n_neg))
    ).otherwise(0.0)
    strong = (F.col("pos") >= least) & (odds > 2.5) & (F.col("pos") * n_neg >= F.col("neg") * n_pos * 8) & (gain > 20)
    order = [F.desc("odds"), F.desc("pos"), "term"]
    words = counts.where(F.length("word") >= 4).where(strong).select(F.col("word").alias("term"), "pos", odds.alias("odds"))
    heads = counts.where(F.length("word") > STEM[0]).select(
        F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM])).alias("head"), "pos", "neg"
    )
    heads = heads.where("head is not null").groupBy("head").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("forms"))
    stems = heads.where((F.col("forms") >= 4) & (F.col("pos") >= 4 * least) & (odds > 4.5)).where(strong)
    stems = stems.select(F.concat("head", F.lit("*")).alias("term"), "pos", odds.alias("odds"))
    found = stems.orderBy(F.length("term"), *order).collect()
    out: dict[str, float] = {}
    # a stem gives way to a longer one that has nearly all of its texts
    held = {r["term"][:-1]: r["pos"] for r in found}
    longer = {s[:-1] for s, n in held.items() if n >= 0.9 * held.get(s[:-1], n + n)}
    for r in found:
        stem = r["term"][:-1]
        if stem not in longer and not any(stem.startswith(s[:-1]) for s in out):
            out[r["term"]] = r["odds"]
    stem_list = [s[:-1] for s in out]
    for r in words.orderBy(*order).collect():
        if not any(r["term"].startswith(s) for s in stem_list):
            out[r["term"]] = r["odds"]
    return {t: min(w, 8.0) / 8.0 for t, w in out.items()}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[list[float], float]:
    """Ridge logistic regression by Newton's method; the weights of hits stay at zero or above, but not those of
    quoted hits and cues."""
    a = np.hstack([x, np.ones((len(x), 1))])
    free = np.ones(a.shape[1], bool)
    for _ in range(4):
        w = np.zeros(a.shape[1])
        penalty = np.diag([ridge] * x.shape[1] + [1e-3])[np.ix_(free, free)]
        b = a[:, free]
        v = w[free]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(b @ v, -30, 30)))
            step = np.linalg.solve((b * (p * (1 - p))[:, None]).T @ b + penalty, b.T @ (y - p) - penalty @ v)
            v = v + step
            if np.abs(step).max() < 1e-8:
                break
        w[free] = v
        wrong = np.asarray([w[i] < 0 and FEATURES[i] not in ("quoted", "cues") for i in range(len(FEATURES))] + [False])
        if not wrong.any():
            break
        free &= ~wrong
    return w[:-1].tolist(), float(w[-1])


def learn(labelled: DataFrame, max_rows: int = MAX_ROWS, least: int = 5) -> Model:
    """A model from ``labelled (doc_id, text, label)`` rows with label 0 or 1, at most ``max_rows`` of them, chosen by a
    hash of doc_id. Words are counted on Spark. Terms, the harmless words within their reach, cue words and the features are
    collected: all of them that pass their tests, whose number the bounded sample bounds.
    Without rows of both labels the model gives every text the same low score."""
    rows = labelled.where("label in (0, 1)").select("doc_id", "text", F.col("label").cast("int"))
    # only ids are sorted; their number is bounded, so that side of the join is small
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    chosen = keep(chosen.repartition(max(8, chosen.sparkSession.sparkContext.defaultParallelism), "doc_id"), "labelled")
    sizes = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_neg, n_pos = sizes.get(0, 0), sizes.get(1, 0)
    if not n_neg or not n_pos:
        return Model()
    counts = keep(_word_counts(chosen), "words")
    model = Model(terms=_lexicon(counts, n_pos, n_neg, least))
    if not model.terms:
        return model
    # words that reach a term by edits or a stem but are at home in clean texts
    model.harmless = frozenset(_harmless(counts, model, n_pos, n_neg))
    model.cues = _cues(chosen, model)
    rows = map_batches(chosen, _feature_batch(model), "label int, features array<double>").collect()
    x = np.asarray([r["features"] for r in rows], float)
    y = np.asarray([r["label"] for r in rows], float)
    model.weights, model.intercept = _logistic(x, y)
    return model


def _feature_batch(model: Model):
    scorer: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scorer:
            scorer.append(scorer_of(model))
        values = [scorer[0].features(t) for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["label"].cast(pa.int32()), pa.array(values, pa.list_(pa.float64()))], names=["label", "features"])

    return run


def _harmless(counts: DataFrame, model: Model, n_pos: int, n_neg: int) -> list[str]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(model.terms)
        for batch in batches:
            words = [w for w in batch["word"].to_pylist() if w not in model.terms and matcher.match(w)]
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string())})

    clean = counts.where((F.col("neg") > 0) & (F.col("pos") * n_neg < F.col("neg") * n_pos * 8))
    near = clean.select("word", "neg").mapInArrow(run, "word string")
    return [r["word"] for r in near.collect()]


def _cues(rows: DataFrame, model: Model) -> dict[str, float]:
    """Words near hits that tell labelled from other texts, such as those that introduce a quotation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in batches:
            words, labels = [], []
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                tokens, found = scorer.hits(text)
                near = {bare(w) for i, _ in found for w in tokens[max(0, i - WINDOW) : i + WINDOW + 1]}
                words += near
                labels += [label] * len(near)
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "label": pa.array(labels, pa.int32())})

    near = rows.mapInArrow(run, "word string, label int").groupBy("word").agg(
        F.sum(1 - F.col("label")).alias("neg"), F.sum("label").alias("pos")
    )
    odds = F.log(F.col("pos") + 1.0) - F.log(F.col("neg") + 1.0)
    # only what also stands near hits in clean texts says anything
    told = near.where("neg >= 5 and word <> ''").select("word", odds.alias("odds")).collect()
    return {r["word"]: max(-3.0, min(3.0, r["odds"])) for r in told}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the score, 0 to 1, of every whole text of ``docs (doc_id, text, ...)``. Null and empty texts get the
    score of a text without hits; repeated rows are scored each; other columns are ignored."""
    scorer: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scorer:
            scorer.append(scorer_of(model))
        values = [scorer[0].score(t) for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(values, pa.float64())], names=["doc_id", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, score double")
