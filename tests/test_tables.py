import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators import cached
from strata.sources import append_table, overwrite_table, read_table, skip_seen
from tests.conftest import plan_of, values


def test_appends_merge_new_columns(rows, spark, folder):
    append_table(rows("k int", 1), folder)
    append_table(rows("k int, v string", (2, "x")), folder)
    assert values(read_table(spark, folder)) == [(1, None), (2, "x")]


def test_explicit_schema_needs_no_inference(rows, spark, folder):
    append_table(rows("k int", 1), folder)
    df = read_table(spark, folder, schema="k int, later string")
    assert values(df) == [(1, None)]


def test_overwrite_replaces_rows_schema_and_partitions(rows, spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        overwrite_table(rows("k int, old int", (1, 1), (2, 2)), folder, partition_cols=["k"])
        overwrite_table(rows("k int, new string", (2, "x")), folder, partition_cols=["k"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert values(read_table(spark, folder).select("k", "new")) == [(2, "x")]


def test_null_partition_values_come_back(rows, spark, folder):
    overwrite_table(rows("v int, y int", (1, 2024), (2, None)), folder, partition_cols=["y"])
    assert values(read_table(spark, folder)) == [(1, 2024), (2, None)]


def test_numeric_looking_text_partitions_stay_text(rows, spark, folder):
    overwrite_table(rows("v int, status string", (1, "001"), (2, "010")), folder, partition_cols=["status"])
    assert read_table(spark, folder).dtypes[-1] == ("status", "int")
    assert values(read_table(spark, folder, text_partitions=["status"])) == [(1, "001"), (2, "010")]


def test_partition_filters_reach_the_scan(rows, spark, folder):
    data = [(i, 2023 + i % 2, i % 12) for i in range(48)]
    overwrite_table(rows("v int, y int, m int", *data), folder, partition_cols=["y", "m"])
    plan = plan_of(read_table(spark, folder).filter("y = 2024 and m = 3").select("v"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "y#" in filters and "m#" in filters
    assert "ReadSchema: struct<v:int>" in plan


def test_writes_rebalance_by_partition_value(spark, folder):
    """A hot partition value is split over tasks; small values do not scatter."""
    i = F.col("id")
    part = F.when(i % 4 != 0, F.lit(0)).otherwise(i % 40)
    df = spark.range(200_000).select(i, F.sha2(i.cast("string"), 256).alias("h"), part.alias("p"))
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.shuffle.partitions": "200",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        overwrite_table(df, folder, partition_cols=["p"])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = read_table(spark, folder).groupBy("p", F.col("_metadata.file_path")).count()
    per_value = {r.p: r["count"] for r in files.groupBy("p").count().collect()}
    assert per_value.pop(0) > 3
    assert sum(per_value.values()) <= len(per_value) + 2
    assert read_table(spark, folder).count() == 200_000


def test_counts_ride_on_the_write(rows, folder):
    seen = Observation()
    df = rows("v int, p int", *[(i, i % 2) for i in range(10)])
    overwrite_table(
        df, folder, partition_cols=["p"], watch=(seen, [F.count(F.lit(1)).alias("rows")])
    )
    assert seen.get == {"rows": 10}


def test_skip_seen_leaves_out_known_files(rows):
    new = rows("_source_file string, v int", ("f1", 1), ("f2", 2), ("f2", 3))
    held = rows("_source_file string", "f1", "f1")
    assert sorted(r.v for r in skip_seen(new, held).collect()) == [2, 3]


def test_cache_lives_for_the_block(spark):
    df = spark.range(5).withColumn("v", F.rand(1))
    with cached(df, materialize=True) as held:
        assert held.is_cached and "InMemoryTableScan" in plan_of(held.select("v"))
    assert not df.is_cached
    with cached(df, None) as held:
        assert held is df and not held.is_cached


def test_cache_is_released_after_an_error(spark):
    df = spark.range(5)
    with pytest.raises(RuntimeError), cached(df):
        raise RuntimeError
    assert not df.is_cached
