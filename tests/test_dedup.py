from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import dedup_latest, dedup_stats
from tests.conftest import plan_of, values

SCHEMA = "k string, t int, v string"


def test_newest_wins_then_ties_are_broken(rows):
    df = rows(SCHEMA, ("a", 1, "old"), ("a", 2, "z"), ("a", 2, "b"), ("b", None, "x"), ("b", 0, "y"))
    assert values(dedup_latest(df, ["k"], "t")) == [("a", 2, "b"), ("b", 0, "y")]


def test_without_order_all_columns_decide(rows):
    df = rows(SCHEMA, ("a", 2, "b"), ("a", 1, "z"), ("a", 1, None))
    assert values(dedup_latest(df, ["k"])) == [("a", 1, None)]


def test_null_keys_form_one_group(rows):
    df = rows(SCHEMA, (None, 1, "x"), (None, 2, "y"), ("a", 1, "z"))
    assert values(dedup_latest(df, ["k"], "t")) == [(None, 2, "y"), ("a", 1, "z")]


def test_key_only_table(rows):
    assert values(dedup_latest(rows("k int", 1, 1, 2), ["k"])) == [(1,), (2,)]


def test_each_map_task_sends_one_row_per_key(rows):
    """The hot-key guard: a group limit in front of the shuffle, no global sort."""
    df = rows(SCHEMA, ("a", 1, "x")).repartition(3)
    plan = plan_of(dedup_latest(df, ["k"], "t"))
    before_shuffle = plan.split("hashpartitioning(k", 1)[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert "rangepartitioning" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]), st.integers(0, 2), st.sampled_from(["x", "y"])
        ),
        min_size=1,
        max_size=20,
    ),
    parts=st.integers(1, 5),
)
def test_one_row_per_key_whatever_the_partitioning(rows, data, parts):
    df = rows(SCHEMA, *data)
    once = values(dedup_latest(df, ["k"], "t"))
    again = values(dedup_latest(df.repartition(parts, "v"), ["k"], "t"))
    assert once == again
    assert len({r[0] for r in once}) == len(once) == len({d[0] for d in data})


def test_stats_match_the_dedup(rows):
    df = rows(SCHEMA, ("a", 1, "x"), ("a", 2, "x"), (None, 1, "x"), (None, 1, "x"), ("b", 1, "x"))
    assert values(dedup_stats(df, ["k"])) == [(5, 3, 2)]
    assert dedup_latest(df, ["k"]).count() == 3
    assert values(dedup_stats(df.filter(F.lit(False)), ["k"])) == [(0, 0, 0)]
