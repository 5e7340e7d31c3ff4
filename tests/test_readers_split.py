"""JSON arrays over many tasks, rescued fields, file statistics, heavy keys, bucketed tables."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import distinct_sketch, merged_distinct
from strata.operators.heavy import Heavy, broadcast_if_small, heavy_keys, join_heavy
from strata.operators.joins import enrich_left
from strata.plans import kpi
from strata.sources import contracts, json_split, readers, rescued, skipping
from strata.sources.writers import write_bucketed
from tests.conftest import plan_of, values
from verification import queries as registered

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "3000")
    yield
    spark.conf.set(SPLIT, before)


def records(n=400):
    rng = random.Random(3)
    odd = ['a"b', "}{", "\\", '\\"}', "[x],", "é漢", "line\nbreak", 'x}"{y', "", "\\\\", "}" * 9]
    out = [{"shipment_id": f"S{i}", "order_id": rng.choice(odd), "carrier": rng.choice([None, "c", *odd])} for i in range(n)]
    for i in range(0, n, 7):
        out[i]["extra"] = {"a": [1, {"b": rng.choice(odd)}], "c": {}}
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_split_read_equals_the_whole_file_read(spark, folder, small_splits, indent):
    Path(folder).mkdir(parents=True)
    path = f"{folder}/one file.json"
    Path(path).write_text(json.dumps(records(), indent=indent, ensure_ascii=indent is None))
    whole = readers.read_json_contract(spark, path, contracts.LOGISTICS_CONTRACT)
    split = json_split.read_json_array(spark, path, contracts.LOGISTICS_CONTRACT)
    assert values(split) == values(whole) and split.count() == 400
    tasks = json_split._pieces(spark, path).groupBy(F.spark_partition_id()).count()
    assert tasks.count() > 3


def test_a_corrupt_record_costs_no_other(spark, folder, small_splits):
    Path(folder).mkdir(parents=True)
    text = json.dumps(records()).replace('"shipment_id": "S77"', '"shipment_id": nonsense')
    Path(f"{folder}/a.json").write_text(text)
    Path(f"{folder}/b.json").write_text(' [ {"shipment_id":"B1"} ,\n\t{"shipment_id":"B2","order_id":"}"}]\n')
    Path(f"{folder}/c.json").write_text("[]")
    Path(f"{folder}/d.json").write_text("")
    got = json_split.read_json_array(spark, folder, contracts.LOGISTICS_CONTRACT)
    bad = [r._corrupt_record for r in got.where("_corrupt_record is not null").collect()]
    assert len(bad) == 1 and bad[0].startswith('{"shipment_id": nonsense')
    assert got.where("shipment_id is not null").count() == 399 + 2


def test_rescued_fields_and_values(spark, rows):
    contract = T.StructType([T.StructField("Order_Id", T.StringType()), T.StructField("amount", T.DecimalType(10, 2)), T.StructField("tags", T.ArrayType(T.StringType()))])
    lines = [
        '{"ORDER_ID":"a","amount":1.50,"x":{"y":[1]},"tags":["t"]}', '{"order_id":null,"amount":{"a":1},"tags":"no"}', "[1,2]", "nope",
        '{"amount":"7","ORDER":"zz","z":null}', "{}", '{"order_id":"p","ORDER":"q"}', None, '{"order_id":true}',
    ]
    df = rescued.rescue(rows("record string", *[(x,) for x in lines]), contract, renamed={"order": "Order_Id"})
    got = [tuple(r) for r in df.select("Order_Id", F.col("amount").cast("string"), "tags", F.to_json("_rescued_data"), "_corrupt_record").collect()]
    assert df.columns == ["Order_Id", "amount", "tags", "_rescued_data", "_corrupt_record"]
    assert got == [
        ("a", "1.50", ["t"], '{"x":{"y":[1]}}', None), (None, None, None, '{"amount":{"a":1},"tags":"no"}', None),
        (None, None, None, None, "[1,2]"), (None, None, None, None, "nope"), ("zz", "7.00", None, '{"z":null}', None),
        (None, None, None, None, None), ("q", None, None, '{"order_id":"p"}', None), (None, None, None, None, None), ("true", None, None, None, None),
    ]


def test_rescued_records_of_a_split_array(spark, folder, small_splits):
    Path(folder).mkdir(parents=True)
    Path(f"{folder}/a.json").write_text(json.dumps(records()))
    got = rescued.read_json_rescued(spark, folder, contracts.LOGISTICS_CONTRACT, arrays=True)
    assert got.count() == 400 and got.where("_rescued_data is not null").count() == 58 and got.where("_corrupt_record is not null").count() == 0


def test_kept_files_equal_a_scan_of_all(spark, folder):
    df = spark.range(6000).selectExpr("id k", "cast(id / 100 as int) g", "concat('s ', cast(id % 3 as string)) s", "if(id % 7 = 0, null, id * 1.5) v", "date_add(date'2020-01-01', cast(id % 50 as int)) d")
    df.repartitionByRange(12, "k").write.partitionBy("s").parquet(f"{folder}/t x")
    skipping.write_file_stats(spark, f"{folder}/t x", ["g", "v", "s", "d"], f"{folder}/stats")
    table = spark.read.parquet(f"{folder}/t x")
    total = spark.read.parquet(f"{folder}/stats").count()
    cases = [
        ({"g": (20, 25), "s": ("s 1", "s 1")}, "g between 20 and 25 and s = 's 1'"), ({"v": (None, 30.0)}, "v <= 30"),
        ({"v": (8990.0, None), "g": (0, 90)}, "v >= 8990 and g between 0 and 90"), ({"g": (1000, 2000)}, "g between 1000 and 2000"), ({}, "true"),
    ]
    for ranges, sql in cases:
        got = skipping.read_ranges(spark, f"{folder}/t x", f"{folder}/stats", ranges)
        assert values(got.select("k")) == values(table.where(sql).select("k"))
        held = table.where(sql).select(F.url_decode("_metadata.file_path").alias("path")).distinct()
        kept = skipping.kept_files(spark, f"{folder}/stats", ranges)
        assert held.join(kept, "path", "left_anti").count() == 0 and (kept.count() < total or not ranges)


@pytest.mark.parametrize("limit", [10**7, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_heavy_join_equals_the_plain_one(spark, rows, limit, how):
    left = spark.range(4000).selectExpr("if(id % 2 = 0, 'hot', if(id % 5 = 0, null, cast(id as string))) k", "id", "1 same")
    right = spark.range(0, 4000, 3).selectExpr("cast(id as string) k", "id * 2 v").unionByName(rows("k string, v long", ("hot", 5), ("hot", 6), (None, 7)))
    h = Heavy(broadcast_bytes=limit)
    assert heavy_keys(left, "k", h) == ["hot"]
    assert values(join_heavy(left, right, "k", how, h)) == values(left.join(right, "k", how))
    assert values(join_heavy(right, left, "k", how, h)) == values(right.join(left, "k", how))


def test_salted_rows_of_a_heavy_key_are_spread(spark, rows):
    left = spark.range(8000).selectExpr("'hot' k", "1 same")
    right = rows("k string, v long", ("hot", 5))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        joined = join_heavy(left, right, "k", "inner", Heavy(broadcast_bytes=0))
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 8000 and len(sizes) > 1 and max(sizes) < 6000


def test_broadcast_follows_the_measured_size(spark, rows):
    dim = rows("k int, s string", *[(i, "x" * 100) for i in range(50)])
    facts = spark.range(10).selectExpr("cast(id as int) k")
    assert "BroadcastHashJoin" in plan_of(enrich_left(facts, dim, "k", broadcast=True))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(dim, 6200)) and not hinted(broadcast_if_small(dim, 6199))


def test_bucketed_tables_meet_without_a_shuffle(spark, folder):
    sales = registered.clean_sales(spark, "/root/testdata/sf0.001")
    shipments = registered.clean_logistics(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = write_bucketed(sales, "bucketed_sales", f"{folder}/s", ["order_id"], 4)
        b = write_bucketed(shipments, "bucketed_shipments", f"{folder}/l", ["order_id"], 4)
        summary = kpi.executive_summary(a, b, one_row_per_order=True)
        plan = plan_of(summary)
        assert "Exchange" not in plan[plan.index("SortMergeJoin") :]
        columns = [c for c in summary.columns if not c.startswith("_")]
        assert values(summary.select(*columns)) == values(kpi.executive_summary(sales, shipments, one_row_per_order=True).select(*columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("bucketed_sales", "bucketed_shipments"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_merged_sketches_of_hot_and_tiny_groups(spark):
    df = spark.range(60_000).selectExpr("if(id < 50000, 'hot', concat('g', cast(id % 2000 as string))) g", "id % 7 month", "id % 40000 v")
    months = df.groupBy("g", "month").agg(distinct_sketch("v").alias("s"))
    merged = months.groupBy("g").agg(merged_distinct("s").alias("n")).join(df.groupBy("g").agg(F.countDistinct("v").alias("exact")), "g")
    worst = merged.select(F.max(F.abs(F.col("n") - F.col("exact")) / F.col("exact"))).first()[0]
    assert worst < 0.04
