"""Every registered query beside its SQL on the smallest tables, and properties of some plans."""

import duckdb
import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from bindings.registry import QUERIES

SF = "/root/testdata/sf0.001"
READS_TABLES = {"extract_tables", "records_from_pages"}
SLOW = {
    "stream_ingest", "stream_resume", "stream_equals_batch", "run_pipeline", "stream_visits", "stream_skips_loaded", "load_counts",
}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in compare.TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, con, name):
    """Result as in SQL; no cross join anywhere, and Python workers only for reading HTML tables."""
    made = []

    def build(*args):
        made.append(queries()[name](*args))
        return made[0]

    outcome, _ = compare.compare(spark, con, name, build, oracle_sql()[name], SF)
    assert outcome.startswith("ok "), outcome
    text = plan(made[0])
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert ("Python" in text or "InPandas" in text) == (name in READS_TABLES)


@pytest.mark.parametrize("name", ["stream_resume", "run_pipeline", "stream_visits", "stream_skips_loaded", "load_counts"])
def test_slow_query(spark, con, name):
    outcome, _ = compare.compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert outcome.startswith("ok "), outcome


def test_entry(spark):
    assert entry(spark).count() == 200


def test_product_plan_has_no_python_and_no_shuffle(spark):
    from pyspark.sql import functions as F

    from bindings.render import raw_records
    from tariffmill.plans.product import assemble_product

    part = spark.read.parquet(f"{SF}/part.parquet")
    text = plan(assemble_product(raw_records(part), F.current_timestamp()))
    assert "Exchange" not in text and "Python" not in text
