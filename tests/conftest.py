import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tariffmill.session import build_session

    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate a column expression over named string inputs and return the plain Python value."""

    def run(column, **inputs):
        schema = ", ".join(f"{name} {_type(v)}" for name, v in inputs.items()) or "one int"
        df = spark.createDataFrame([tuple(inputs.values()) or (1,)], schema)
        return _plain(df.select(column.alias("v")).collect()[0]["v"])

    return run


def _type(v):
    return "map<string,string>" if isinstance(v, dict) else "string"


def _plain(v):
    if hasattr(v, "asDict"):
        return {k: _plain(x) for k, x in v.asDict().items()}
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return v
