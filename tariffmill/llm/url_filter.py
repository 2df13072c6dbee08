"""URL verdicts: rules by host and path, and gradient-boosted trees on lexical features for what no rule covers."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill.llm.common import keep

#: At most this many labelled rows are used to grow the trees.
MAX_ROWS = 20_000
#: The seed of the trees, and their number and depth.
SEED, TREES, DEPTH = 7, 20, 4
#: Labelled urls fall into this many folds by their hash; statistics leave out a url's own fold, the trees the first one.
FOLDS = 5

FEATURES = [
    "f_length", "f_host", "f_path", "f_dots", "f_depth", "f_digits", "f_digit_runs", "f_hyphens", "f_params", "f_query",
    "f_fragment", "f_secure", "f_entropy", "f_host_entropy", "f_suffix", "f_host_suffix", "f_first_part",
]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of the rules that fits, or null. A rule ``host/path`` fits its host and all subdomains where the path
    starts with its own."""
    out = F.lit(None).cast("string")
    # built from the shortest outwards, so the longest is asked first
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy, in bits, of a text's letters and digits, case aside, and of all other characters as one kind."""
    lowered = F.lower(text)
    own = [F.length(lowered) - F.length(F.replace(lowered, F.lit(c), F.lit(""))) for c in "abcdefghijklmnopqrstuvwxyz0123456789"]
    length = F.length(lowered)
    counts = F.array(*own)
    seen = F.aggregate(counts, F.lit(0), lambda a, n: a + n)
    share = F.transform(F.concat(counts, F.array(length - seen)), lambda n: n / length)
    bits = F.aggregate(share, F.lit(0.0), lambda a, p: a + F.when(p > 0, -p * F.log2(p)).otherwise(0.0))
    return F.when(length > 0, bits).otherwise(0.0)


def lexical(df: DataFrame) -> DataFrame:
    """``df (url, host, path)`` with the features that need no statistics, and the suffixes to look up."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    count = lambda c, what: F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))
    return df.withColumns({
        "f_length": F.length(url), "f_host": F.length("host"), "f_path": F.length("path"), "f_dots": count(F.col("host"), "."),
        "f_depth": F.size(parts), "f_digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "f_digit_runs": F.regexp_count(url, F.lit("[0-9]+")), "f_hyphens": count(url, "-"),
        "f_params": F.when(query == "", 0).otherwise(1 + count(query, "&")), "f_query": F.length(query),
        "f_fragment": url.contains("#").cast("int"), "f_secure": url.startswith("https").cast("int"),
        "f_entropy": entropy(url), "f_host_entropy": entropy(F.col("host")),
        "suffix": F.element_at(labels, -1), "host_suffix": F.concat_ws(".", F.slice(F.reverse(labels), 1, 2)),
        "first_part": F.coalesce(F.get(parts, F.lit(0)), F.lit("")),
    })


def suffix_statistics(labelled: DataFrame, key: str, folds: int = FOLDS) -> DataFrame:
    """Per value of ``key`` the number of blocked and of all labelled rows in each fold, as arrays ``ones`` and ``rows``."""
    ones = [F.sum(F.when(F.col("fold") == i, F.col("label")).otherwise(0.0)) for i in range(folds)]
    rows = [F.count(F.when(F.col("fold") == i, 1)) for i in range(folds)]
    return labelled.groupBy(key).agg(F.array(*ones).alias("ones"), F.array(*rows).alias("rows"))


def blocked_share(strength: float = 20.0) -> Column:
    """The share of blocked rows among those of a key, drawn towards one half where rows are few. A labelled row's own fold
    is left out, so that no url's label, its own or that of a repeated row, is in its features."""
    own = F.when(F.col("label").isNotNull(), F.col("fold"))
    ones, rows = (
        F.coalesce(F.aggregate(c, F.lit(0.0), lambda a, n: a + n), F.lit(0.0)) - F.coalesce(F.get(c, own), F.lit(0.0))
        for c in ("ones", "rows")
    )
    return (ones + strength / 2) / (rows + strength)


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], max_rows: int = MAX_ROWS, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """page_id, host, path, rule and verdict of every url of ``pages (page_id, url, ...)``.

    ``rules`` are pairs of a rule like ``example.org/en/`` and ``allow`` or ``block``. URLs that a rule covers are the
    labelled ones: suffix statistics are counted over all of them, without a labelled url's own fold, and at most
    ``max_rows`` of those beyond the first fold, chosen by a hash of the url, grow the trees. Labelled urls of the first fold
    are marked ``held_out``: their ``probability`` tells how well the trees do. The trees judge the others: block from a probability of one half. With labels of one kind
    only, that kind is the verdict; with none, all are allowed.

    A null url, or one without ``://``, has an empty host and path and is judged by the trees; repeated rows are judged
    alike; other columns are ignored. Column ``probability`` has the trees' for every url, ``blocked`` that of urls without a
    rule; both are null without trees.
    """
    verdicts = dict(rules)
    ruled = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).withColumns({"host": host_of(F.coalesce("url", F.lit(""))), "path": path_of(F.coalesce("url", F.lit("")))})
    ruled = ruled.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    known = F.create_map(*[F.lit(x) for pair in verdicts.items() for x in pair])[F.col("rule")]
    base = keep(lexical(ruled).withColumn("label", F.when(known == "block", 1.0).when(known == "allow", 0.0)), "urls")
    base = base.withColumn("fold", F.pmod(F.xxhash64("url", F.lit(SEED)), F.lit(FOLDS)).cast("int"))
    held_out = (F.col("label").isNotNull() & (F.col("fold") == 0)).alias("held_out")
    labelled = base.where("label is not null")
    kinds = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    by_rule = F.when(F.col("label") == 1, "block").when(F.col("label") == 0, "allow")
    if len(kinds) < 2:
        other = "block" if 1.0 in kinds else "allow"
        return base.select("page_id", "host", "path", "rule", F.coalesce(by_rule, F.lit(other)).alias("verdict"), *[F.lit(None).cast("double").alias(c) for c in ("blocked", "probability")], held_out)
    for key, name in (("suffix", "f_suffix"), ("host_suffix", "f_host_suffix"), ("first_part", "f_first_part")):
        base = base.join(suffix_statistics(labelled, key), key, "left").withColumn(name, blocked_share()).drop("ones", "rows")
    base = keep(base, "features")
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # with few labelled urls the other folds may lack a label; then all of them grow the trees
    grown = base.where("label is not null and fold <> 0")
    if grown.select("label").distinct().count() < 2:
        grown, held_out = base.where("label is not null"), F.lit(False).alias("held_out")
    sample = grown.orderBy(F.xxhash64("url"), "url", "page_id").limit(max_rows)
    sample = keep(vector.transform(sample).select("features", "label").repartition(8, F.xxhash64("features")), "sample")
    model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=SEED, stepSize=0.3).fit(sample)
    judged = model.transform(vector.transform(base)).withColumn("probability", vector_to_array("probability")[1])
    by_trees = F.when(F.col("probability") >= 0.5, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_trees).alias("verdict"), F.when(F.col("rule").isNull(), F.col("probability")).alias("blocked"),
        "probability", held_out,
    )
