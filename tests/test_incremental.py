"""Upserts, replaced partitions, numbers and refreshed KPI state, against full rebuilds."""

import random
from pathlib import Path

import pytest

from strata.operators import dedup_latest
from strata.operators.numbering import add_numbers
from strata.plans import kpi, state
from strata.scratch import scratch_dir, scratch_scope
from strata.sources import LayerPaths, overwrite_table
from strata.sources.partitions import in_partitions, partitions_of, replace_partitions
from strata.sources.upsert import upsert_latest
from tests.conftest import values
from verification import queries as registered

ROW = "k int, y int, m string, v string, t int"


def files(path):
    return {str(f) for f in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_a_rebuild_and_keeps_other_files(spark, folder, rows, seed):
    rng = random.Random(seed)
    some = lambda k: (k, rng.choice([None, 1, 2, 3]), rng.choice(["a", "b/c d", "07"]), f"v{rng.random()}", rng.choice([None, *range(6)]))
    arrived = dedup_latest(rows(ROW, *[some(k) for k in range(40)]), ["k"], "t", ["v"])
    arrived.write.partitionBy("y", "m").parquet(folder)
    for _ in range(3):
        changes = rows(ROW, *[some(rng.randrange(50)) for _ in range(6)], some(None))
        arrived = dedup_latest(arrived.unionByName(changes), ["k"], "t", ["v"])
        want, before = values(arrived.select("k", "y", "m", "v", "t")), files(folder)
        touched = upsert_latest(spark, changes, folder, ["k"], "t", ["y", "m"], tie_breakers=["v"], text_partitions=["m"])
        got = spark.read.schema(ROW).parquet(folder)
        assert values(got.select("k", "y", "m", "v", "t")) == want
        folders = {tuple("__HIVE_DEFAULT_PARTITION__" if v is None else str(v).replace("/", "%2F") for v in p) for p in touched}
        changed = {tuple(part.split("=", 1)[1] for part in Path(f).parts[-3:-1]) for f in before ^ files(folder)}
        assert changed <= folders


def test_late_and_equal_changes_touch_nothing_else(spark, folder, rows):
    first = rows(ROW, (1, 1, "a", "x", 5), (2, 2, "a", "x", 5))
    first.write.partitionBy("y", "m").parquet(folder)
    before = files(folder)
    assert upsert_latest(spark, rows(ROW, (1, 2, "a", "late", 4), (2, 1, "a", "none", None)), folder, ["k"], "t", ["y", "m"]) == []
    assert files(folder) == before
    assert upsert_latest(spark, spark.createDataFrame([], ROW), folder, ["k"], "t", ["y", "m"]) == []


def test_a_partition_without_rows_disappears(spark, folder, rows):
    rows(ROW, (1, 1, "a", "x", 1), (2, 2, "a", "x", 1)).write.partitionBy("y", "m").parquet(folder)
    assert set(upsert_latest(spark, rows(ROW, (1, 2, "a", "moved", 2)), folder, ["k"], "t", ["y", "m"])) == {(1, "a"), (2, "a")}
    assert not Path(f"{folder}/y=1/m=a").exists()
    assert partitions_of(spark.read.parquet(folder), ["y", "m"]) == [(2, "a")]


def test_replacing_partitions_checks_its_rows(spark, folder, rows):
    df = rows(ROW, (1, 1, "a", "x", 1), (2, None, "a", "x", 1))
    df.write.partitionBy("y", "m").parquet(folder)
    with pytest.raises(ValueError, match="outside"):
        replace_partitions(df, folder, ["y", "m"], [(1, "a")])
    table = spark.read.parquet(folder)
    assert table.where(in_partitions(["y", "m"], [(None, "a")])).count() == 1
    plan = table.where(in_partitions(["y"], [(1,)]))._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: []" not in plan


def test_numbers_have_no_gaps_and_stay(spark, folder, rows):
    first = add_numbers(rows("c string", ("b",), ("a",), ("b",), (None,)), "c", folder)
    assert values(first) == [("a", 0), ("b", 1)]
    many = rows("c string", *[(f"x{i}",) for i in range(300)], ("a",))
    found = dict(values(add_numbers(many, "c", folder)))
    assert found["a"] == 0 and found["b"] == 1 and sorted(found.values()) == list(range(302))
    assert values(add_numbers(many, "c", folder)) == sorted(found.items())


def test_refreshed_state_equals_a_full_aggregation(spark, folder, rows):
    sales = registered.clean_sales(spark, "/root/testdata/sf0.001")
    shipments = registered.clean_logistics(spark, "/root/testdata/sf0.001")
    paths, parts = LayerPaths(folder), kpi.MONTH
    overwrite_table(shipments, paths.silver("logistics"), partition_cols=["status"])
    overwrite_table(sales, paths.silver("sales"), partition_cols=parts)
    assert len(state.refresh_state(spark, paths)) == len(partitions_of(sales, parts))
    stored = files(paths.gold("_state/sums"))
    gone, changed = (1995, 3), (1996, 7)
    left = sales.where(in_partitions(parts, [changed])).where("quantity > 3")
    replace_partitions(left, paths.silver("sales"), parts, [gone, changed])
    assert state.refresh_state(spark, paths, [gone, changed]) == [gone, changed]
    renewed = {tuple(p.split("=")[1] for p in Path(f).parts[-3:-1]) for f in stored ^ files(paths.gold("_state/sums"))}
    assert renewed <= {("1995", "3"), ("1996", "7")}
    now = spark.read.parquet(paths.silver("sales"))
    full = {
        "sales_by_region": kpi.sales_by_region(now, one_row_per_order=True),
        "sales_by_category": kpi.sales_by_category(now, one_row_per_order=True),
        "executive_summary": kpi.executive_summary(now, shipments, one_row_per_order=True),
    }
    for name, plan in full.items():
        columns = [c for c in plan.columns if not c.startswith("_")]
        assert values(state.TABLES[name](spark, paths).select(*columns)) == values(plan.select(*columns))


def test_state_reads_changed_months_only(spark, folder):
    sales = registered.clean_sales(spark, "/root/testdata/sf0.001")
    overwrite_table(sales, folder, partition_cols=kpi.MONTH)
    chosen = spark.read.parquet(folder).where(in_partitions(kpi.MONTH, [(1995, 3)]))
    chosen.count()
    scan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in scan and "PartitionFilters: []" not in scan
    assert {(r.order_year, r.order_month) for r in chosen.collect()} == {(1995, 3)}


def test_scratch_folders_go_with_their_scope(spark):
    with scratch_scope(spark) as made:
        path = scratch_dir(spark, "scoped")
        spark.range(3).write.parquet(path)
        assert made == [path] and Path(path).exists()
    assert not Path(path).exists()
