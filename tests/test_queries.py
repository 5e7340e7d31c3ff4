"""Every registered query against its DuckDB oracle."""

import os

import pytest

import __spark_entry__ as contract
from verification import compare
from verification import queries as registered

TABLES = os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(TABLES)


def test_every_query_has_an_oracle():
    assert set(registered.queries()) <= set(contract.queries())
    assert set(registered.queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, TABLES)
    assert compare.differences(df, duck, contract.oracle_sql()[name]) == []


def test_entry_is_lazy_and_has_rows(spark):
    df = contract.entry(spark)
    assert "mom_growth_pct" in df.columns and df.count() > 0
