"""Code lists, raw records, landed pages and catalogue tables as DataFrames."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmill.functions.text import strip
from tariffmill.schemas import CODE_LIST_SCHEMA, PAGE_SCHEMA, RAW_SCHEMA

log = logging.getLogger(__name__)


def spread(df: DataFrame, parts: int) -> DataFrame:
    """Deal rows out evenly over ``parts`` before costly row-by-row work on a table that is read in few parts."""
    return df.repartition(parts)


def src_code_list(spark: SparkSession, path: str) -> DataFrame:
    """Codes of a CSV with a header, stripped, empty ones dropped, with their place in the input.

    ``input_pos`` sorts by file, then block, then row, and is taken on the scan, before any shuffle.
    A missing file is logged and gives no codes.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    try:
        listed = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("code list not found: %s", path)
        return spark.createDataFrame([], CODE_LIST_SCHEMA).withColumn(
            "input_pos", F.lit(None).cast("struct<file:string,block:bigint,row:bigint>")
        )
    return listed.select(strip(F.col("hs_code")).alias("hs_code"), place.alias("input_pos")).where("hs_code <> ''")


def src_raw_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw records: a JSON array per file, or with ``multi_line=False`` one record per line.

    Only the second form can be split, so large landings should use it.
    """
    return spark.read.schema(RAW_SCHEMA).option("multiLine", multi_line).json(path)


def src_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed HTML pages."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def stream_pages(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Landed HTML pages as a stream of new files."""
    return spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def src_table_scan(spark: SparkSession, path: str) -> DataFrame:
    """All rows and columns of a table."""
    return spark.read.parquet(path)


def src_jdbc_table(
    spark: SparkSession, url: str, table: str, partition_column: str, bounds: tuple[int, int], partitions: int
) -> DataFrame:
    """All rows of a database table, read in parallel ranges of a numeric column."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
    )
