"""Quality rules: base rules on word statistics, then robust multivariate outliers within language and source."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill.llm.common import SPACES, encoded, keep, map_batches

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
#: Least spread per transformed statistic, used where a group's own is smaller. In a text of 50 words one symbol, one repeated line
#: of ten and one repeated run each use a third of the cut; 6 symbols per 100 words, 24 % of lines or 30 % of words reject alone.
FLOORS = {"v_length": 0.08, "v_symbols": 0.33, "v_lines": 0.21, "v_repeats": 0.24}
VECTOR = list(FLOORS)
#: Quantiles of chi-square with four degrees of freedom (fixed values): median, and upper 1e-6.
CHI2_MEDIAN, CHI2_CUT = 3.3567, 33.38


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a run of ``window`` words found twice or more, the first time included."""
    if len(words) <= window:
        return 0
    runs = list(zip(*(words[i:] for i in range(window)), strict=False))
    number = Counter(runs)
    if len(number) == len(runs):
        return 0
    hit = np.fromiter((number[r] > 1 for r in runs), bool, len(runs))
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + len(hit)] |= hit
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five base counts of one text; null counts as empty."""
    text = text or ""
    raw = encoded(text)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document; other columns are ignored."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [text_counts(t) for t in batch["text"].to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        lines = pa.array([1 + (t or "").count("\n") for t in batch["text"].to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["lang"], batch["source"], *columns, lines],
            names=["doc_id", "lang", "source", *COUNTS, "n_lines"],
        )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))
    return map_batches(narrow, run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in [*COUNTS, "n_lines"]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vectors() -> dict[str, Column]:
    """Shares of a text rather than sizes, on scales where ordinary texts are about normal."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "v_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "v_symbols": F.log1p(100 * F.col("n_symbols") / words),
        "v_lines": F.log1p(10 * F.col("n_dup_lines") / F.col("n_lines")),
        "v_repeats": F.log1p(10 * F.col("n_repeat_words") / words),
    }


def _moments() -> list[Column]:
    firsts = [F.sum(a).alias(f"s_{a}") for a in VECTOR]
    seconds = [F.sum(F.col(a) * F.col(b)).alias(f"q_{a}_{b}") for i, a in enumerate(VECTOR) for b in VECTOR[i:]]
    return [F.count("*").alias("n_fit"), *firsts, *seconds]


def _estimate(pdf, floors: np.ndarray):
    """Mean and inverse covariance of each row of sums; only variances below their floor are raised to it."""
    n = pdf["n_fit"].to_numpy(float)
    d = len(VECTOR)
    mean = np.stack([pdf[f"s_{a}"].to_numpy(float) / n for a in VECTOR], 1)
    cov = np.empty((len(pdf), d, d))
    for i, a in enumerate(VECTOR):
        for j, b in enumerate(VECTOR[i:], i):
            cov[:, i, j] = cov[:, j, i] = pdf[f"q_{a}_{b}"].to_numpy(float) / n - mean[:, i] * mean[:, j]
    spread = np.arange(d)
    # the small share on top keeps statistics that depend on each other invertible
    cov[:, spread, spread] = np.maximum(cov[:, spread, spread], floors**2) * (1 + 1e-6)
    return mean, np.linalg.inv(cov)


def _fit(moments: DataFrame, key: list[str]) -> DataFrame:
    """Centre and inverse covariance per group from its sums: a few numbers for each group, computed where the row is."""
    floors = np.asarray([FLOORS[a] for a in VECTOR])
    schema = ", ".join([f"{k} string" for k in key] + ["centre array<double>", "inverse array<double>"])

    def run(parts):
        for pdf in parts:
            mean, inverse = _estimate(pdf, floors)
            out = pdf[key].copy()
            out["centre"] = list(mean)
            out["inverse"] = [m.ravel() for m in inverse]
            yield out

    return moments.mapInPandas(run, schema)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of the row's vector from its group's centre."""
    d = len(VECTOR)
    delta = [F.col(a) - F.col("centre")[i] for i, a in enumerate(VECTOR)]
    terms = [delta[i] * delta[j] * F.col("inverse")[i * d + j] for i in range(d) for j in range(d)]
    return sum(terms[1:], terms[0])


#: Squared distances are compared on a grid of this many steps per power of two, so that order never matters.
STEPS = 32


def _step(distance: Column) -> Column:
    return F.floor(F.log2(F.greatest(distance, F.lit(1e-9))) * STEPS).cast("int")


def _cut_at(rows: DataFrame, key: list[str], share: float, name: str) -> DataFrame:
    """Per group the smallest step of the distance grid that at least ``share`` of its rows do not exceed.

    Rows are counted per group and step first, so a group reaches the window as at most a few thousand counts.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(*key, "step").agg(F.count("*").alias("n"))
    by = Window.partitionBy(*key)
    run = counts.withColumn("upto", F.sum("n").over(by.orderBy("step"))).withColumn("all", F.sum("n").over(by))
    return run.where(F.col("upto") >= F.col("all") * share).groupBy(*key).agg(F.min("step").alias(name))


def _centres(rows: DataFrame, key: list[str], kept_share: float, c_steps: int) -> DataFrame:
    """Minimum-covariance-determinant estimates per ``key``: start from all rows, then keep the ``kept_share`` of rows
    nearest to the present centre and estimate anew; each such step lowers the determinant."""
    fit = keep(_fit(rows.groupBy(*key).agg(*_moments()), key), "mcd")
    for _ in range(c_steps):
        near = rows.join(fit, key).withColumn("step", _step(squared_distance()))
        cut = _cut_at(near, key, kept_share, "cut")
        chosen = near.join(cut, key).where(F.col("step") <= F.col("cut"))
        fit = keep(_fit(chosen.groupBy(*key).agg(*_moments()), key), "mcd")
    # consistency: the median distance of ordinary rows is that of chi-square
    near = rows.join(fit, key).withColumn("step", _step(squared_distance()))
    return fit.join(_cut_at(near, key, 0.5, "middle"), key)


def judge(
    docs: DataFrame, min_group: int = 200, kept_share: float = 0.75, c_steps: int = 3, cut: float = CHI2_CUT
) -> DataFrame:
    """Counts and verdict of every document of ``docs (doc_id, text, lang, source, ...)``.

    ``base_failed`` is set below 50 words or where over half of the words lie in repeated three-word runs. The others
    are rejected if their vector (mean word length, share of symbols, of repeated lines and of repeated words, all on
    log scales) lies farther than ``cut`` from the centre of their language and source, in squared Mahalanobis distance
    under minimum-covariance-determinant estimates. All rows that pass the base rules take part in the estimates. Groups
    of under ``min_group`` such rows use the estimates of their language, and languages of under ``min_group`` those of
    all rows; with fewer rows still, the same estimates are used as they are. Only directions of worse text count: a
    document is never rejected for fewer symbols or repeats than usual.

    A null text is empty and fails; null lang or source is a group of its own; repeated rows are judged alike; an empty
    table gives an empty result. Returns doc_id, lang, source, counts, base_failed, distance, kept.
    """
    counted = keep(with_counts(docs), "counts")
    rows = (
        counted.where(~base_failed())
        .select(F.coalesce("lang", F.lit("")).alias("g_lang"), F.coalesce("source", F.lit("")).alias("g_source"), *[c.alias(n) for n, c in vectors().items()])
        .withColumn("g_all", F.lit("all"))
    )
    by_source, by_lang, by_all = ["g_lang", "g_source"], ["g_lang"], ["g_all"]
    sizes = keep(rows.groupBy("g_all", *by_source).agg(F.count("*").alias("n_source")), "sizes")
    langs = sizes.groupBy("g_lang").agg(F.sum("n_source").alias("n_lang"))
    groups = sizes.join(langs, "g_lang")
    level = F.when(F.col("n_source") >= min_group, "source").when(F.col("n_lang") >= min_group, "lang").otherwise("all")
    groups = keep(groups.withColumn("level", level).select("g_all", *by_source, "level"), "groups")
    label = F.concat_ws(
        "\x1f", "level", F.when(F.col("level") != "all", F.col("g_lang")), F.when(F.col("level") == "source", F.col("g_source"))
    )
    groups = groups.withColumn("g", label)
    # every level that some group needs, each over all of its rows
    needed = groups.select("g", "level").distinct()
    wide = rows.select(
        *VECTOR,
        F.explode(
            F.array(
                F.concat_ws("\x1f", F.lit("source"), "g_lang", "g_source"), F.concat_ws("\x1f", F.lit("lang"), "g_lang"), F.lit("all")
            )
        ).alias("g"),
    ).join(needed.select("g"), "g", "left_semi")
    centres = _centres(keep(wide, "vectors"), ["g"], kept_share, c_steps)
    fitted = keep(groups.select(*by_source, "g").join(centres, "g").drop("g"), "fitted")
    judged = (
        counted.withColumns({**vectors(), "g_lang": F.coalesce("lang", F.lit("")), "g_source": F.coalesce("source", F.lit(""))})
        .join(fitted, by_source, "left")
        .withColumns({a: F.greatest(F.col(a), F.col("centre")[i]) for i, a in enumerate(VECTOR) if a != "v_length"})
    )
    # the grid step of the median over that of chi-square's, never below one
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("middle") + 1) / STEPS) / CHI2_MEDIAN, F.lit(1.0))
    distance = squared_distance() / scale
    failed = base_failed()
    return judged.select(
        "doc_id", "lang", "source", *COUNTS, failed.alias("base_failed"),
        F.when(~failed, distance).alias("distance"),
        (~failed & (F.coalesce(distance, F.lit(0.0)) <= cut)).alias("kept"),
    )
