"""Document fingerprints: threshold-scaled sketches of shingle hashes, mergeable, for containment of unequal documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash values are this many hexadecimal digits of MD5, so that any SQL engine can compute them.
DIGITS = 8


def shingles_of(words: Column, size: int) -> Column:
    """All runs of ``size`` words as strings; fewer words are one run; no words, none."""
    runs = F.greatest(F.size(words) - size + 1, F.lit(1))
    each = F.transform(F.sequence(F.lit(1), runs), lambda i: F.array_join(F.slice(words, i, size), " "))
    return F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<string>"))


def hashed(shingles: Column) -> Column:
    return F.transform(shingles, lambda s: F.substring(F.md5(s), 1, DIGITS))


def threshold_hex(fraction: float) -> str:
    """The least hash that is not below ``fraction`` of the range, as text."""
    return f"{min(int(fraction * 16**DIGITS), 16**DIGITS - 1):0{DIGITS}x}"


def sketch(hashes: Column, fraction: float, floor: int) -> Column:
    """The distinct hashes below the fraction, sorted; where these are under ``floor``, the ``floor`` least of all."""
    bound = threshold_hex(fraction)
    low = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < bound)))
    return F.when(F.size(low) >= floor, low).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, floor))


def _reach(kept: Column, fraction: float, floor: int) -> Column:
    """Up to which hash a sketch knows its document's set: a whole set all, a floored one its last hash, else the fraction."""
    bound = threshold_hex(fraction)
    top = "g"  # above every hexadecimal digit
    last = F.element_at(kept, -1)
    return F.when(F.size(kept) < floor, top).otherwise(F.greatest(last, F.lit(bound)))


def likeness(a: Column, b: Column, fraction: float, floor: int) -> Column:
    """Estimated containment of the smaller set in the larger, 0 to 1, from two sketches.

    Both are cut at the reach they share. Two empty sketches are alike, one empty sketch is like nothing.
    """
    reach = F.least(_reach(a, fraction, floor), _reach(b, fraction, floor))
    # the reach itself belongs to a floored sketch and lies beyond the others
    part_a, part_b = (F.filter(x, lambda h: h <= reach) for x in (a, b))
    smaller = F.least(F.size(part_a), F.size(part_b))
    common = F.size(F.array_intersect(part_a, part_b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when(smaller == 0, 0.0)
        .otherwise(common.cast("double") / smaller)
    )


def merged(sketches: Column) -> Column:
    """The sketch of a union from the array of its parts' sketches (those that are not floored)."""
    return F.sort_array(F.array_distinct(F.flatten(sketches)))


def words_of(text: Column) -> Column:
    """Words between ASCII white space, A-Z lower-cased."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def in_ranges(docs: DataFrame, per_range: int = 2000, most_ranges: int = 20_000) -> DataFrame | None:
    """``docs (doc_id, text)`` dealt into ranges (``bucket``) of doc_id, so that a window within a range meets the next row.

    Ranges hold about ``per_range`` rows; of very many rows there are ``most_ranges`` larger ones. Their borders are
    percentiles of all ids, one number each. The first row of a range, in descending order, also joins the range above as
    its last row (``guest``), and that of the uppermost the lowest, so each text is shuffled once. None if there are no rows.
    """
    n, low = docs.agg(F.count("*"), F.min("doc_id")).first()
    if not n:
        return None
    docs = docs.withColumn("id", F.coalesce("doc_id", F.lit((low or 0) - 1)))
    ranges = min(max(1, n // per_range), most_ranges)
    cuts: list[int] = []
    if ranges > 1:
        points = [i / ranges for i in range(1, ranges)]
        cuts = sorted({int(x) for x in docs.agg(F.percentile_approx("id", points, 10 * ranges)).first()[0]})
    # borders in two levels, so that finding a row's range takes about the square root of their number
    width = max(1, round(len(cuts) ** 0.5))
    rows = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    if rows:
        heads = F.array(*[F.lit(r[0]).cast("long") for r in rows])
        table = F.array(*[F.array(*[F.lit(x).cast("long") for x in r]) for r in rows])
        row = F.size(F.filter(heads, lambda x: x <= F.col("id")))
        inner = F.size(F.filter(F.coalesce(F.get(table, row - 1), F.array().cast("array<bigint>")), lambda x: x <= F.col("id")))
        bucket = F.when(row > 0, (row - 1) * width + inner).otherwise(0)
    else:
        bucket = F.lit(0)
    placed = docs.withColumn("bucket", bucket.cast("int"))
    found = dict(placed.groupBy("bucket").agg(F.max("id")).collect())
    held = sorted(found)
    above = {b: held[(i + 1) % len(held)] for i, b in enumerate(held)}

    def looked_up(of: dict[int, int]) -> Column:
        return F.get(F.array(*[F.lit(of.get(b)).cast("long") for b in range(len(cuts) + 1)]), F.col("bucket"))

    own = F.struct("bucket", F.lit(False).alias("guest"))
    guest = F.struct(looked_up(above).cast("int").alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.col("id") == looked_up(found), F.array(own, guest)).otherwise(F.array(own))
    dealt = placed.select("doc_id", "id", "text", F.explode(places).alias("to"))
    return dealt.select("doc_id", "id", "text", "to.bucket", "to.guest")


def fingerprints(docs: DataFrame, size: int = 5, fraction: float = 0.125, floor: int = 32) -> DataFrame:
    """Sketches of every whole text of ``docs (doc_id, text, ...)`` and of its edited text, and their likeness.

    The edited text has its last ``n_chars div 2`` code points replaced by as many (or all) first ones of the next
    document, in descending order of doc_id, the first after the last. Shingles are ``size`` lower-cased words; every
    hash below ``fraction`` is kept, and at least the ``floor`` least, so that short texts are kept whole. ``near_*`` is
    the estimated containment of the smaller set.

    A null text is empty; texts without words have an empty sketch, and two such are alike. A null doc_id comes
    last; rows with equal doc_id follow each other in order of their texts. An only row is its own next. Returns doc_id,
    n_chars, edited_text, sketch, edited_sketch, next_sketch, near_edited, near_next.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = in_ranges(narrow)
    if placed is None:
        placed = narrow.select("doc_id", F.col("doc_id").alias("id"), "text", F.lit(0).alias("bucket"), F.lit(False).alias("guest"))
    sketched = _sketched(placed.repartition("bucket"), "text", "sketch", size, fraction, floor)
    order = Window.partitionBy("bucket").orderBy(F.col("guest"), F.desc("id"), "text")
    after = sketched.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)}).where("not guest")
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substring(next_text, 1, cast(floor(length(text) / 2) as int))"))
    after = after.select("doc_id", n_chars.cast("long").alias("n_chars"), F.when(half > 0, edited).otherwise(F.col("text")).alias("edited_text"), "sketch", "next_sketch")
    after = _sketched(after, "edited_text", "edited_sketch", size, fraction, floor)
    return after.select(
        "doc_id", "n_chars", "edited_text", "sketch", "edited_sketch", "next_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch"), fraction, floor).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), fraction, floor).alias("near_next"),
    )


def _sketched(df: DataFrame, text: str, name: str, size: int, fraction: float, floor: int) -> DataFrame:
    """``df`` with the sketch of a text column, each step evaluated once."""
    rest = df.columns
    df = df.select(*rest, words_of(F.col(text)).alias("_words"))
    df = df.select(*rest, hashed(shingles_of(F.col("_words"), size)).alias("_hashes"))
    return df.select(*rest, sketch(F.col("_hashes"), fraction, floor).alias(name))


def fingerprint_text(kept: Column) -> Column:
    """A sketch as one string."""
    return F.array_join(kept, "")
