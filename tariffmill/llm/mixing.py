"""Mixing to target weights: budgets down a tree of domain, language and source, then a token prefix of each leaf."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffmill.llm.common import keep

LEVELS = ["domain", "language", "origin"]
#: Weights are whole numbers, so that budgets are exact whole numbers on every engine.
WHOLE = "decimal(38,0)"
#: Ranges of the seeded order within a leaf are made to hold about this many rows.
RANGE_ROWS = 2000


def shares(children: DataFrame, parent: list[str]) -> DataFrame:
    """Divide each parent's ``budget`` among its children by ``weight``, none above its ``room``.

    A child that cannot use its share takes all it has, and what is short goes to its siblings by weight; only what all
    of them cannot take is lost to the parent, whose own siblings got it a level above. Children fill up in order of
    room per weight, so one pass over the sums of those before decides. Shares are rounded down.
    """
    fill = Window.partitionBy(*parent).orderBy((F.col("room").cast("double") / F.col("weight")).asc_nulls_last(), *LEVELS)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    zero = F.lit(0).cast(WHOLE)
    sums = children.withColumns({
        "room_before": F.coalesce(F.sum("room").over(before), zero), "weight_before": F.coalesce(F.sum("weight").over(before), zero),
        "weight_all": F.sum("weight").over(whole),
    })
    sums = sums.withColumn(
        "full", (F.col("weight") > 0) & (F.col("room") * (F.col("weight_all") - F.col("weight_before")) <= F.col("weight") * (F.col("budget") - F.col("room_before")))
    )
    sums = sums.withColumns({
        "room_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(whole), zero),
        "weight_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(whole), zero),
    })
    rest = F.expr("cast((weight * (budget - room_full)) div (weight_all - weight_full) as decimal(38,0))")
    share = F.when(F.col("full"), F.col("room")).when(F.col("weight") > 0, rest).otherwise(zero)
    return sums.select(*children.columns, share.cast(WHOLE).alias("share"))


def weight_of(weights: dict[str, int], name: str, default: int) -> Column:
    out = F.lit(default)
    for value, weight in weights.items():
        out = F.when(F.col(name) == value, weight).otherwise(out)
    return out.cast(WHOLE)


def budgets(
    leaves: DataFrame, percent: int, max_epochs: int, weights: dict[str, dict[str, int]], default: dict[str, int]
) -> DataFrame:
    """Token budget of each leaf ``(domain, language, origin, tokens)``.

    The whole budget is ``percent`` of all tokens; a leaf has room for ``max_epochs`` times its tokens, an inner node
    for what its leaves have. From the root down each level's budgets are divided by :func:`shares`.
    """
    leaf = leaves.withColumn("room", (F.col("tokens") * max_epochs).cast(WHOLE))
    language = leaf.groupBy("domain", "language").agg(F.sum("room").cast(WHOLE).alias("room"))
    domain = language.groupBy("domain").agg(F.sum("room").cast(WHOLE).alias("room"))
    tokens = leaves.agg(F.sum("tokens")).first()[0] or 0
    nothing = F.lit("")
    top = domain.withColumns({"budget": F.lit(tokens * percent // 100).cast(WHOLE), "root": nothing, "language": nothing, "origin": nothing, "weight": weight_of(weights["domain"], "domain", default["domain"])})
    top = shares(top, ["root"]).select("domain", F.col("share").alias("budget"))
    middle = language.join(top, "domain").withColumns({"origin": nothing, "weight": weight_of(weights["language"], "language", default["language"])})
    middle = shares(middle, ["domain"]).select("domain", "language", F.col("share").alias("budget"))
    low = leaf.join(middle, ["domain", "language"]).withColumn("weight", weight_of(weights["origin"], "origin", default["origin"]))
    return shares(low, ["domain", "language"]).select(*LEVELS, "tokens", F.col("share").cast("long").alias("budget"))


def seeded(seed: int) -> Column:
    """A row's place in its epoch's order, as text that sorts alike everywhere."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def choose(
    docs: DataFrame, percent: int = 60, max_epochs: int = 2, seed: int = 17,
    weights: dict[str, dict[str, int]] | None = None, default: dict[str, int] | None = None,
) -> DataFrame:
    """The rows of ``docs (doc_id, domain, language, origin, n_tokens)`` that a mixture takes, with their epoch.

    Leaf budgets come from :func:`budgets`. A leaf is read in epochs, each a seeded order of all of its rows; the chosen
    rows are the longest prefix of this stream whose tokens stay within the budget, so all but the last epoch are
    whole. Positions in the stream come from sums over ranges of the seeded order and over rows within a range, so
    no task holds a leaf.

    Rows without tokens cost nothing: they are taken where the prefix reaches them. Null levels are the empty text. Rows with equal doc_id
    in one leaf stand next to each other, in order of their tokens. Leaves without budget give no rows. Returns doc_id,
    levels, n_tokens, epoch, place (tokens of the stream before the row), budget.
    """
    weights = {level: {} for level in LEVELS} | (weights or {})
    default = {level: 1 for level in LEVELS} | (default or {})
    rows = docs.select("doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in LEVELS], F.col("n_tokens").cast("long"))
    leaves = keep(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows")), "leaves")
    planned = budgets(leaves.select(*LEVELS, "tokens"), percent, max_epochs, weights, default)
    planned = keep(planned.join(leaves.select(*LEVELS, "n_rows"), LEVELS), "budgets").where("budget > 0")
    # whole epochs, and the one that is cut; no row can be in later ones
    last = F.least(F.expr("budget div tokens"), F.lit(max_epochs - 1)).cast("int")
    ranged = planned.withColumns({
        "last_epoch": last, "ranges": F.least(F.greatest(F.expr(f"n_rows div {RANGE_ROWS}"), F.lit(1)), F.lit(1 << 20)),
    })
    epochs = rows.join(ranged, LEVELS).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("last_epoch"))))
    placed = epochs.withColumn("sort_key", seeded(seed)).withColumn(
        "part", F.expr("cast((conv(substring(sort_key, 1, 8), 16, 10) * ranges) div 4294967296 as long)")
    )
    keys = [*LEVELS, "epoch", "part"]
    sums = placed.groupBy(*keys).agg(F.sum("n_tokens").alias("held"), F.first("tokens").alias("tokens"))
    upto = Window.partitionBy(*LEVELS, "epoch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, (F.col("epoch") * F.col("tokens") + F.coalesce(F.sum("held").over(upto), F.lit(0))).alias("from"))
    within = Window.partitionBy(*keys).orderBy("sort_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    streamed = placed.join(starts, keys).withColumn("place", F.col("from") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    taken = streamed.where(F.col("place") + F.col("n_tokens") <= F.col("budget"))
    return taken.select("doc_id", *LEVELS, "n_tokens", "epoch", "place", "budget")
