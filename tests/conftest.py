from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from strata.session import tune  # noqa: E402
from strata.scratch import scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


@pytest.fixture
def folder(spark):
    """A new folder path per test."""
    return scratch_dir(spark, "test")


@pytest.fixture
def rows(spark):
    """DataFrame from literal rows and a DDL schema."""

    def make(schema: str, *data):
        return spark.createDataFrame([d if isinstance(d, tuple) else (d,) for d in data], schema)

    return make


def plan_of(df) -> str:
    """Physical plan text."""
    return df._jdf.queryExecution().executedPlan().toString()


def values(df) -> list[tuple]:
    """All rows, sorted with nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])
