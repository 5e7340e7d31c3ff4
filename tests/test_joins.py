from pyspark.sql import functions as F

from strata.operators import attach, enrich_left, preaggregate_then_left_join
from tests.conftest import plan_of, values


def test_left_join_keeps_facts_and_shows_the_key_once(rows):
    facts = rows("k int, a string", (1, "x"), (2, "y"), (None, "z"))
    dim = rows("k int, b string", (1, "one"), (None, "none"))
    joined = enrich_left(facts, dim, "k")
    assert joined.columns == ["k", "a", "b"]
    assert values(joined) == [(None, "z", None), (1, "x", "one"), (2, "y", None)]


def test_broadcast_is_a_choice(spark, rows):
    facts, dim = rows("k int", 1, 2), rows("k int, b int", (1, 1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan_of(enrich_left(facts, dim, "k"))
        assert "BroadcastHashJoin" in plan_of(enrich_left(facts, dim, "k", broadcast=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_preaggregation_prevents_fan_out(rows):
    left = rows("k int, v int", (1, 10), (2, 20))
    right = rows("k int, w int", (1, 1), (1, 2), (1, 3))
    joined = preaggregate_then_left_join(left, right, ["k"], [F.sum("w").alias("w")])
    assert values(joined) == [(1, 10, 6), (2, 20, None)]


def test_attach_matches_null_keys_also_in_a_self_join(rows):
    df = rows("g string, h int, v int", ("a", 1, 1), ("a", None, 2), (None, None, 3), (None, None, 4))
    sums = df.groupBy("g", "h").agg(F.sum("v").alias("s"))
    assert values(attach(df, sums, ["g", "h"])) == [
        (None, None, 3, 7), (None, None, 4, 7), ("a", None, 2, 2), ("a", 1, 1, 1),
    ]
