"""Upserts into the catalogue tables, surrogate ids, parent look-up and change detection.

All reductions per key are plain aggregates, so Spark combines them before the shuffle and a key that
holds a third of a batch reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return _edge_per_key(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return _edge_per_key(df, keys, order, F.max_by)


def _edge_per_key(df: DataFrame, keys, order, edge) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns])
    reduced = df.groupBy(*keys).agg(edge(row, F.struct(*[F.col(c) for c in order])).alias("_row"))
    return reduced.select("_row.*")


def upsert_insert_only(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows to add: the first incoming row of every key the target lacks. Known keys stay untouched."""
    fresh = first_per_key(incoming, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def upsert_overwrite_labels(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    overwrite: Sequence[str] = ("label", "present"),
    last_order: Sequence[str] | None = None,
) -> DataFrame:
    """Touched rows: ``overwrite`` columns from the last incoming row, the others as they were.

    For new keys the others come from the first incoming row. ``last_order`` is for rows that are already
    reduced and so carry a first and a last place. Keys the batch does not touch are not returned.
    """
    places = {*order, *(last_order or ())}
    columns = [c for c in incoming.columns if c in target.columns or c not in places]
    rest = [c for c in columns if c not in keys and c not in overwrite]
    reduced = incoming.groupBy(*keys).agg(
        F.max_by(F.struct(*overwrite), F.struct(*(last_order or order))).alias("_new"),
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"),
    )
    known = target.select(*keys, F.struct(*rest).alias("_old"))
    merged = reduced.join(known, list(keys), "left")
    return merged.select(
        *keys,
        *[F.col(f"_new.{c}").alias(c) for c in overwrite],
        *[
            F.when(F.col("_old").isNull(), F.col(f"_first.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
            for c in rest
        ],
    ).select(*columns)


def upsert_on_hash_change(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    as_of: Column,
    hash_col: str = "canonical_hash",
    keep: Sequence[str] = ("hs6_id",),
    updated_at: str = "updated_at",
) -> DataFrame:
    """Touched rows of a product upsert.

    Columns come from the last incoming row; ``keep`` columns are set on insert only. ``updated_at``
    moves to ``as_of`` when a replay of the batch row by row would meet a changed hash: the key is new,
    the batch holds several hashes for it, or its only hash differs from the stored one.
    """
    value_cols = [c for c in incoming.columns if c not in keys and c not in keep and c != updated_at]
    keep = [c for c in keep if c in incoming.columns]
    at = F.struct(*[F.col(c) for c in order])
    marked = F.coalesce(F.concat(F.lit("h"), F.col(hash_col)), F.lit("null"))
    reduced = incoming.groupBy(*keys).agg(
        F.max_by(F.struct(*value_cols), at).alias("_new"),
        *([F.min_by(F.struct(*keep), at).alias("_first")] if keep else []),
        (F.min(marked) != F.max(marked)).alias("_mixed"),
    )
    old = target.select(*keys, F.struct(*keep, hash_col, updated_at).alias("_old"))
    merged = reduced.join(old, list(keys), "left")
    is_new = F.col("_old").isNull()
    changed = is_new | F.col("_mixed") | ~F.col(f"_old.{hash_col}").eqNullSafe(F.col(f"_new.{hash_col}"))
    columns = (
        list(keys)
        + [F.col(f"_new.{c}").alias(c) for c in value_cols]
        + [F.when(is_new, F.col(f"_first.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in keep]
        + [F.when(changed, as_of).otherwise(F.col(f"_old.{updated_at}")).alias(updated_at)]
    )
    order_out = [c for c in incoming.columns if c != updated_at] + [updated_at]
    return merged.select(*columns).select(*order_out)


def apply_touched(target: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole table after an upsert: touched rows plus the target rows of all other keys."""
    untouched = target.join(touched.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(touched, allowMissingColumns=True)


def classify_changes(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], hash_col: str
) -> DataFrame:
    """new, changed, unchanged or untouched per key, from one join."""
    last = incoming.groupBy(*keys).agg(
        F.struct(F.max_by(hash_col, F.struct(*order)).alias("hash")).alias("_new")
    )
    old = target.select(*keys, F.struct(F.col(hash_col).alias("hash")).alias("_old"))
    kind = (
        F.when(F.col("_new").isNull(), "untouched")
        .when(F.col("_old").isNull(), "new")
        .when(F.col("_new.hash").eqNullSafe(F.col("_old.hash")), "unchanged")
        .otherwise("changed")
    )
    return old.join(last, list(keys), "full").select(*keys, kind.alias("change"))


def replay_upserts(df: DataFrame, keys: Sequence[str], ts: str, tie: str, hash_col: str) -> DataFrame:
    """Time of the last row of each key whose hash differs from the row before it.

    Rows are first dealt out in ranges of (key, time), so that a hot key is spread over many ranges. Each
    range reports, per key, its first and last hash and its own last change; a window over these few
    summaries finds the changes between ranges. No task holds all rows of a hot key.
    """
    ranged = df.select(*keys, ts, tie, hash_col).repartitionByRange(*keys, ts, tie)
    within = Window.partitionBy(*keys, "_range").orderBy(ts, tie)
    before = F.struct(F.lag(hash_col).over(within).alias("hash"), F.lag(F.lit(True)).over(within).alias("known"))
    at = F.struct(ts, tie)
    ranges = (
        ranged.withColumn("_range", F.spark_partition_id())
        .withColumn("_before", before)
        .groupBy(*keys, "_range")
        .agg(
            F.min_by(F.struct(F.col(hash_col).alias("hash")), at).alias("_first"),
            F.max_by(F.struct(F.col(hash_col).alias("hash")), at).alias("_last"),
            F.min(ts).alias("_first_ts"),
            F.max(
                F.when(F.col("_before.known") & ~F.col("_before.hash").eqNullSafe(F.col(hash_col)), F.col(ts))
            ).alias("_change_ts"),
        )
    )
    between = Window.partitionBy(*keys).orderBy("_range")
    previous = F.lag("_last").over(between)
    own = F.coalesce("_change_ts", F.when(F.col("_starts_change"), F.col("_first_ts")))
    return (
        ranges.withColumn("_starts_change", ~previous.eqNullSafe(F.col("_first")))
        .groupBy(*keys)
        .agg(F.max(own).alias("updated_at"))
    )


def assign_surrogate_ids(
    new: DataFrame, existing: DataFrame, keys: Sequence[str], code: str, prefix: int = 4, id_col: str = "id"
) -> DataFrame:
    """Dense ids for new keys in order of their code, after the highest existing id.

    ``new`` must hold each key once, with codes of digits. Rows are numbered within the leading digits of the code, and the
    digit groups (10,000 at most for 4 digits) are offset by a running count, so no task sorts all keys.
    """
    grouped = new.withColumn("_group", F.substring(code, 1, prefix))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(code, *[k for k in keys if k != code]))
    # The highest existing id sorts first, as the size of an empty digit group.
    top = existing.agg(F.lit("").alias("_group"), F.coalesce(F.max(id_col), F.lit(0)).alias("_n"))
    sizes = grouped.groupBy("_group").agg(F.count("*").alias("_n")).unionByName(top)
    running = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_group", F.sum("_n").over(running).alias("_offset")).where("_group <> ''")
    return (
        grouped.withColumn("_rank", rank)
        .join(offsets, "_group")
        .withColumn(id_col, (F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_group", "_rank", "_offset")
    )


def resolve_parent_ids(
    child: DataFrame, parent: DataFrame, on: dict[str, str], parent_id: str, id_col: str = "id"
) -> DataFrame:
    """Give each child row the id of its parent; ``on`` maps child column to parent column.

    Parent keys are unique, so one inner join does it; Spark broadcasts the parents where their size allows and splits a hot key
    of the children where it does not.
    """
    lookup = parent.select(*[F.col(p).alias(c) for c, p in on.items()], F.col(id_col).alias(parent_id))
    return child.join(lookup, list(on), "inner")


def delete_blockers(doomed: DataFrame, children: DataFrame, key: str, foreign_key: str) -> DataFrame:
    """RESTRICT: parents that may not go because children point to them, with the number of those."""
    used = children.groupBy(F.col(foreign_key).alias(key)).agg(F.count("*").alias("children"))
    return doomed.select(key).distinct().join(used, key, "inner")


def cascade_delete(rows: DataFrame, doomed: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """CASCADE: detail rows that remain when their parents go."""
    return rows.join(doomed.select(F.col(key).alias(foreign_key)), foreign_key, "left_anti")
