"""Run a query and its oracle on the same tables and compare all values and types."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from strata.session import tune
from verification.oracles import oracle_sql
from verification.queries import queries


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(
            f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')"
        )
    return connection


# Type names that mean the same in both engines.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty when results are the same."""
    relation = connection.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    actual_types = {c: SAME_TYPE.get(t, t) for c, t in df.dtypes}
    found = []
    if actual_types != expected_types:
        found.append(f"types: {actual_types} != {expected_types}")
    if set(actual_types) != set(expected_types):
        return found
    actual = _bag(df.columns, [tuple(r) for r in df.collect()])
    expected = _bag(relation.columns, relation.fetchall())
    extra, missing = actual - expected, expected - actual
    if extra or missing:
        found.append(
            f"rows {actual.total()} vs {expected.total()}; {extra.total()} only in Spark, e.g. "
            f"{list(extra)[:2]}; {missing.total()} only in DuckDB, e.g. {list(missing)[:2]}"
        )
    elif not actual:
        found.append("no rows")
    return found


def check(spark: SparkSession, sf_dir: str, name: str) -> list[str]:
    return differences(queries()[name](tune(spark), sf_dir), connect(sf_dir), oracle_sql()[name])
