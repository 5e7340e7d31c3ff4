from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.ranges import order_codes, range_edges, range_id
from strata.sources import append_table, compact, maintenance, orphan_files, read_table, zorder
from strata.sources.maintenance import data_files, interleave, planned_files, with_z_value


def bag(df):
    columns = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture
def stored(spark, folder):
    """3,000 rows in 12 writes; one partition value and one row hold a third or more each."""
    src = f"{folder}/src"
    i = F.col("id")
    df = spark.range(3000).select(
        F.when(i % 3 == 0, F.lit(7)).otherwise(i % 100).alias("x"),
        F.when(i % 3 == 0, F.lit(7)).otherwise(i * 7919 % 1000).alias("y"),
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (i % 4).cast("string"))).alias("p"),
        F.when(i % 50 != 1, F.concat(F.lit("item-"), F.lpad((i % 300).cast("string"), 4, "0"))).alias("s"),
    )
    append_table(df.repartition(12), src, partition_cols=["p"])
    return src


def rows_per_file(spark, path):
    return [
        r["count"]
        for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    ]


def test_compaction_keeps_rows_and_splits_the_hot_partition(spark, stored, folder):
    dst = f"{folder}/compact"
    compact(spark, stored, dst, target_files=6, partition_cols=["p"])
    assert bag(read_table(spark, dst)) == bag(read_table(spark, stored))
    files = data_files(spark, dst)
    assert files.count() < data_files(spark, stored).count()
    assert files.filter(F.col("path").contains("p=hot")).count() >= 2
    assert max(rows_per_file(spark, dst)) < 1000


def test_unpartitioned_compaction_needs_no_shuffle(spark, folder):
    src, dst = f"{folder}/src", f"{folder}/dst"
    spark.range(100).repartition(10).write.parquet(src)
    compact(spark, src, dst, target_files=2)
    assert data_files(spark, dst).count() <= 2
    assert bag(spark.read.parquet(dst)) == bag(spark.read.parquet(src))


def test_planned_files_follow_the_stored_bytes(spark, stored):
    total = data_files(spark, stored).agg(F.sum("bytes")).first()[0]
    assert planned_files(spark, stored) == 1
    assert planned_files(spark, stored, target_bytes=-(-total // 5)) == 5


@pytest.mark.parametrize("partition_cols", [[], ["p"]])
def test_zorder_keeps_rows_and_splits_hot_cells(spark, stored, folder, partition_cols):
    dst = f"{folder}/z{len(partition_cols)}"
    zorder(spark, stored, dst, ["x", "y", "s"], target_files=6, partition_cols=partition_cols)
    assert bag(read_table(spark, dst)) == bag(read_table(spark, stored))
    # A third of the rows are the same (x, y); no file may hold all of them.
    assert max(rows_per_file(spark, dst)) < 1000


def test_zorder_narrows_the_range_of_every_column_per_file(spark, folder):
    src, dst = f"{folder}/src", f"{folder}/dst"
    i = F.col("id")
    spark.range(4000).select((i * 7919 % 1000).alias("x"), (i * 104729 % 1000).alias("y")).repartition(
        16
    ).write.parquet(src)
    zorder(spark, src, dst, ["x", "y"], target_files=16)

    def spans(path):
        file = F.col("_metadata.file_path").alias("f")
        per_file = spark.read.parquet(path).groupBy(file).agg(
            (F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")
        )
        return per_file.agg(F.avg("x"), F.avg("y")).first()

    assert all(after < 0.5 * before for after, before in zip(spans(dst), spans(src), strict=True))


def test_interleave_alternates_bits(rows):
    df = rows("a int, b int", (0b101, 0b010), (0b111, 0b000))
    got = [r[0] for r in df.select(interleave([F.col("a"), F.col("b")], 3)).collect()]
    assert got == [0b011001, 0b010101]
    with pytest.raises(ValueError):
        interleave([F.col("a")] * 4, 16)


def test_codes_sort_like_their_columns(spark, rows):
    data = [
        ("ORD-0001", datetime(2024, 1, 1), True), ("ORD-0010", datetime(2023, 5, 1), False),
        ("ORD-0002é", None, None), (None, datetime(1950, 1, 1), False), ("ORD-", None, True),
    ]
    df = rows("s string, t timestamp, b boolean", *data)
    codes = order_codes(df, df.columns)
    for column in df.columns:
        pairs = df.select(column, codes[column].alias("code")).collect()
        known = sorted((r for r in pairs if r[0] is not None), key=lambda r: r[0])
        assert [r.code for r in known] == sorted(r.code for r in known)
        assert all(r.code is None for r in pairs if r[0] is None)


def test_ranges_are_even_and_monotone(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * F.col("id"))
    edges = range_edges(df, {"v": F.col("v")}, 8)["v"]
    sizes = df.groupBy(range_id(F.col("v"), edges).alias("r")).count().orderBy("r").collect()
    assert [r.r for r in sizes] == list(range(8))
    assert all(100 <= r["count"] <= 150 for r in sizes)
    assert range_edges(df.filter("id < 0"), {"v": F.col("v")}, 8) == {"v": []}


def test_z_value_of_nulls_is_the_lowest_range(rows):
    df = rows("x int", None, 1, 2, 3, 4)
    got = {r.x: r["__z"] for r in with_z_value(df, ["x"], bits=2).collect()}
    assert got[None] == 0 and got[4] == max(got.values())


def test_orphans_are_old_files_the_table_does_not_read(spark, folder):
    for version in ("v1", "v2"):
        spark.range(10).withColumn("part", F.lit("a b%c")).write.partitionBy("part").parquet(
            f"{folder}/{version}"
        )
    live = read_table(spark, f"{folder}/v2")
    later = datetime.now() + timedelta(hours=200)
    orphans = [r.path for r in orphan_files(spark, folder, live, as_of=later).collect()]
    assert orphans and all("/v1/" in p for p in orphans)
    assert orphan_files(spark, folder, live).count() == 0  # younger than the retention
    manifest = data_files(spark, f"{folder}/v1").select("path")
    others = orphan_files(spark, folder, manifest, 0, as_of=later).collect()
    assert others and all("/v2/" in r.path for r in others)


def test_rewrites_keep_partition_values_and_layout(spark, folder):
    rows = spark.range(40).selectExpr("id", "lpad(id % 3, 3, '0') AS p", "concat('k', id) AS k")
    rows.write.partitionBy("p").parquet(f"{folder}/src")
    maintenance.compact(spark, f"{folder}/src", f"{folder}/compact")
    maintenance.zorder(spark, f"{folder}/src", f"{folder}/z", ["k"])
    for name in ("compact", "z"):
        assert maintenance.stored_partitions(spark, f"{folder}/{name}") == ["p"]
        paths = maintenance.data_files(spark, f"{folder}/{name}").select("path").collect()
        assert {r.path.split("/")[-2] for r in paths} == {"p=000", "p=001", "p=002"}


def test_one_odd_text_does_not_merge_the_ranges(spark):
    ids = spark.range(4000).selectExpr("printf('ORD-%09d', id) AS k")
    odd = ids.union(spark.sql("SELECT 'n/a'"))
    for df in (ids, odd):
        ranges = maintenance.with_z_value(df, ["k"], bits=5).groupBy("__z").count().collect()
        assert len(ranges) == 32 and max(r["count"] for r in ranges) < 200
