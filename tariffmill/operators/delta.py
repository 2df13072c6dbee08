"""Which codes to refresh: recent keys, the anti join against them, the limit, and run counts."""

from __future__ import annotations

import logging
from datetime import datetime

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmill.patterns import REFRESH_DAYS
from tariffmill.session import shared_dir
from tariffmill.sources.store import CatalogueStore

log = logging.getLogger(__name__)


def recent_keys(
    products: DataFrame, as_of: Column | datetime, days: int = REFRESH_DAYS, key: str = "hs10"
) -> DataFrame:
    """Keys updated within the last days; the date filter reaches the scan."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    oldest = now - F.make_dt_interval(F.lit(days))
    return products.where(F.col("updated_at") > oldest).select(key).distinct()


def empty_keys(spark: SparkSession, key: str = "hs10") -> DataFrame:
    return spark.createDataFrame([], f"{key} string")


def keys_to_skip(
    store: CatalogueStore, as_of: Column | datetime, days: int = REFRESH_DAYS, force: bool = False, key: str = "hs10"
) -> DataFrame:
    """Recent keys of the catalogue's products; none when forced. A store without products, or one that cannot be read,
    counts as empty: the run then starts afresh, and says so in the log.

    The keys are written to shared scratch at once: a file that cannot be read shows here, not in the middle of the run, and
    the set stays as it was when the run changes the store.
    """
    spark = store.spark
    if force:
        return empty_keys(spark, key)
    path = shared_dir(spark, "skip")
    try:
        recent_keys(store.read("hs_products", [key, "updated_at"]), as_of, days, key).write.parquet(path)
    except (PySparkException, Py4JError) as error:
        log.warning("no skip set from %s: %s", store.root, error)
        return empty_keys(spark, key)
    return spark.read.schema(f"{key} string").parquet(path)


def delta_anti_join(codes: DataFrame, skip: DataFrame, code: str = "hs_code", key: str = "hs10") -> DataFrame:
    """Codes not in the skip set.

    The skip set grows with the catalogue, so no broadcast is asked for: Spark broadcasts it while its
    measured size allows, and splits a hot code of the other side where it does not.
    """
    return codes.join(skip.select(F.col(key).alias(code)), code, "left_anti")


def limit_codes(codes: DataFrame, n: int | None, position: str = "input_pos") -> DataFrame:
    """First n codes in input order; no limit for None or 0."""
    return codes.orderBy(position).limit(n) if n else codes


def run_counts(codes: DataFrame, skip: DataFrame, code: str = "hs_code", key: str = "hs10") -> DataFrame:
    """One row: codes listed, skipped and to be processed.

    Codes are counted per key first, so a code listed very often takes one row into the join.
    """
    listed = codes.groupBy(F.col(code).alias(key)).agg(F.count("*").alias("n"))
    seen = listed.join(skip.select(key, F.lit(True).alias("seen")), key, "left")
    return seen.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("listed"),
        F.coalesce(F.sum(F.when(F.col("seen"), F.col("n"))), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("seen").isNull(), F.col("n"))), F.lit(0)).alias("processed"),
    )
