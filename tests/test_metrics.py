from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import functions as fn
from tests.conftest import values


def test_sums_means_and_any_true(rows):
    df = rows("g string, v double, b boolean", ("a", 1.005, True), ("a", None, None), ("b", 2.0, None))
    got = df.groupBy("g").agg(
        fn.total(F.col("v")), fn.mean(F.col("v"), 1), fn.any_true(F.col("b"))
    )
    assert values(got) == [("a", 1.01, 1.0, True), ("b", 2.0, 2.0, None)]


def test_ratio_by_zero_is_null(rows):
    df = rows("x double, y double", (1.0, 0.0), (0.0, 0.0), (1.0, 3.0), (None, 1.0))
    got = [r[0] for r in df.select(fn.ratio(F.col("x"), F.col("y"), 2, 100)).collect()]
    assert got == [None, None, 33.33, None]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    pairs=st.lists(
        st.tuples(st.integers(-(10**22), 10**22), st.integers(-(10**22), 10**22)),
        min_size=1, max_size=20,
    )
)
def test_exact_ratio_is_the_true_quotient_rounded_half_up(rows, pairs):
    pairs += [(1, 8), (-1, 8), (5, 0), (0, 5), (0, -5), (1, -200), (4999999, 10**9), (1, 3)]
    df = rows(
        "x decimal(28,2), y decimal(28,2)",
        *[(Decimal(x).scaleb(-2), Decimal(y).scaleb(-2)) for x, y in pairs],
    )

    def expected(x, y):
        if y == 0:
            return None
        size = (2 * abs(x) * 10000 + abs(y)) // (2 * abs(y))
        return Decimal(size if (x < 0) == (y < 0) else -size).scaleb(-2)

    got = df.select(fn.ratio(F.col("x"), F.col("y"), 2, 100, exact=True)).collect()
    assert [r[0] for r in got] == [expected(x, y) for x, y in pairs]


def test_exact_mean_rounds_once(spark):
    """One cent too few over ten million rows: 0.00499999... must not reach 0.01."""
    cents = F.when(F.col("id") < 4_999_999, F.lit("0.01")).otherwise(F.lit("0.00"))
    df = spark.range(10_000_000).select(cents.cast("decimal(18,2)").alias("v"))
    got = df.agg(F.round(F.avg("v"), 2).cast("double"), fn.mean(F.col("v"), 2, exact=True).cast("double"))
    assert tuple(got.first()) == (0.01, 0.0)


def test_rate_counts_unknown_flags_in_the_base(rows):
    df = rows("id int, ok boolean", (1, True), (2, False), (3, None), (4, True))
    rate = fn.rate_pct(F.col("ok"), F.count("id"))
    assert df.agg(rate).first()[0] == 50.0


def test_first_by_keeps_null_values(rows):
    df = rows("g int, t int, v string", (1, 2, "late"), (1, 1, None), (2, 5, "only"))
    got = df.groupBy("g").agg(fn.first_by(F.col("v"), [F.col("t")]))
    assert values(got) == [(1, None), (2, "only")]


def test_distinct_with_unique_input_is_a_count(rows):
    df = rows("k string", "a", "b", None)
    got = df.agg(fn.distinct("k"), fn.distinct("k", unique=True)).first()
    assert tuple(got) == (2, 2)
