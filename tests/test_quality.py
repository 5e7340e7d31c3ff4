import pytest
from pyspark.sql import functions as F

from strata.functions import parse_money
from strata.operators import null_gate, profile, rejected, row_count
from tests.conftest import plan_of, values


def test_gate_checks_the_key_it_is_given(rows):
    df = rows("order_id int, shipment_id int", (1, None), (2, 2), (3, 3), (None, 4))
    assert values(null_gate(df, "shipment_id")) == [(4, 1, 25.0, False)]
    assert values(null_gate(df, "shipment_id", max_pct=25.0)) == [(4, 1, 25.0, True)]


def test_gate_on_an_empty_table_passes(rows):
    df = rows("k int", 1).filter(F.lit(False))
    assert values(null_gate(df, "k")) == [(0, 0, 0.0, True)]


def test_profile_has_one_row_per_column(rows):
    df = rows("a int, `b.c` string", *[(i, None if i < 2 else "x") for i in range(20)])
    assert values(profile(df)) == [("a", 20, 0, 0.0, False), ("b.c", 20, 2, 10.0, True)]


def test_profile_scans_once(folder, spark):
    spark.range(5).write.parquet(folder)
    assert plan_of(profile(spark.read.parquet(folder))).count("FileScan") == 1


def test_rejected_lists_every_reason(rows):
    df = rows("k string, v string", ("a", "1"), (None, "2"), ("b", None), (None, "x"), ("c", "x"))
    bad = rejected(df, ["k", "v"], {"v": parse_money(F.col("v"))})
    got = {(r.k, r.v): r._reject_reasons for r in bad.collect()}
    assert got == {
        (None, "2"): ["missing:k"],
        ("b", None): ["missing:v"],
        (None, "x"): ["missing:k", "unreadable:v"],
        ("c", "x"): ["unreadable:v"],
    }


@pytest.mark.parametrize("n", [0, 7])
def test_row_count(spark, n):
    assert row_count(spark.range(n)).first()["rows"] == n
