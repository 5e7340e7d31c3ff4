"""What the third review found, one test for each mended step."""

import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

import __spark_entry__ as contract
from strata.functions import parse
from strata.plans import kpi, layers, state
from strata.sources import LOGISTICS_CONTRACT, LayerPaths, maintenance, manifest, read_json_contract
from tests.conftest import plan_of, values
from verification import compare
from verification import fixtures as fx
from verification import queries as registered

TABLES = "/root/testdata/sf0.001"


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_f1_years_of_five_digits_have_no_sign(spark, folder):
    spark.range(1).select(F.explode(F.array(*map(F.lit, (0, 1, 2_932_896, 2_932_897, 8_999_999, 106_000_000)))).alias("o_orderkey")).select(
        F.col("o_orderkey").cast("long")
    ).write.parquet(f"{folder}/orders.parquet")
    got = contract.queries()["src_session"](spark, folder).collect()
    duck = compare.duckdb.connect()
    duck.execute(f"CREATE VIEW orders AS SELECT * FROM '{folder.removeprefix('file://')}/orders.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(duck.execute(contract.oracle_sql()["src_session"]).fetchall())


def test_f2_a_listing_is_not_joined_by_one_task(spark, folder, setting, monkeypatch):
    paths = LayerPaths(folder)

    def ingest(names):
        for table, text in (("sales", "a\n1\n"), ("logistics", "[]")):
            for name in names:
                target = Path(paths.raw(table)) / name
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text(text)
        layers.run_bronze(spark, paths, paths.raw("sales"), paths.raw("logistics"), only_new_files=True)

    setting("spark.sql.files.maxPartitionBytes", "1k")
    ingest("ab")  # only a manifest with rows is joined as a broadcast
    real = manifest.new_files

    def with_tasks(*given):
        def mark(batches):
            for batch in batches:
                task = pa.array([TaskContext.get().taskAttemptId()] * batch.num_rows, pa.int64())
                yield pa.record_batch([*batch.columns[:2], task], ["path", "modified", "bytes"])

        return real(*given).mapInArrow(mark, "path string, modified timestamp, bytes long")

    monkeypatch.setattr(manifest, "new_files", with_tasks)
    ingest("cdef")
    for table in ("sales", "logistics"):
        listed = spark.read.parquet(paths.manifest(table)).where(~F.col("path").rlike("/[ab]$"))
        assert listed.count() == 4 and listed.select("bytes").distinct().count() > 1


def test_f10_raw_arrays_are_small_and_whole(spark, folder, monkeypatch):
    monkeypatch.setattr(fx, "FILE_ROWS", 500)
    raw = fx.logistics_raw(spark, TABLES)
    fx.write_logistics_json(raw, folder)
    files = list(Path(folder.removeprefix("file://")).glob("part-*"))
    plain = raw.select(F.sum(F.length(F.to_json(F.struct("shipment_id", "order_id", "carrier", "status"))))).first()[0]
    assert len(files) == raw.count() // 500 and sum(f.stat().st_size for f in files) < plain / 2
    back = read_json_contract(spark, folder, LOGISTICS_CONTRACT)
    columns = ["shipment_id", "order_id", "dispatch_date", "delivery_date", "status"]
    assert back.select(columns).exceptAll(raw.select(columns)).count() == 0 and back.count() == raw.count()


def test_f7_refresh_cleans_sales_once_and_joins_shipments_once(spark, monkeypatch):
    listed, shipped = [], []
    months, joined = registered.partitions.partitions_of, state.preaggregate_then_left_join
    monkeypatch.setattr(registered.partitions, "partitions_of", lambda df, parts: listed.append(plan_of(df)) or months(df, parts))
    monkeypatch.setattr(state, "preaggregate_then_left_join", lambda left, right, *a: shipped.append(plan_of(right)) or joined(left, right, *a))
    got = registered.kpi_refresh(spark, TABLES)
    assert listed and not any("Window" in plan for plan in listed)
    assert ["LeftSemi" in plan for plan in shipped] == [False, True]  # a full refresh, then some months
    assert compare.differences(got, compare.connect(TABLES), contract.oracle_sql()["kpi_refresh"]) == []


def test_f11_sample_of_many_ranges_stays_small(spark, folder, monkeypatch):
    setting = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    spark.range(100).write.parquet(folder)
    seen = []
    monkeypatch.setattr(maintenance, "_write", lambda *_: seen.append(int(spark.conf.get(setting))))
    for files in (5, 1_000, 50_000):
        maintenance.zorder(spark, folder, f"{folder}-z", ["id"], target_files=files)
    assert seen == [100, 20, 10] and spark.conf.get(setting) == "100"


def test_f9_dates_are_read_by_the_layouts_that_fit(spark, rows):
    """A layout that fails throws for every row: most of the cleaning's time."""
    texts = [
        "2024-12-31", "31/12/2024", "12-31-2024", "12/31/2024", "31-12-2024", "1/2/2024", "2024-1-5", "2024-02-30", "20241231",
        "2024/12/31", "+12024-01-02", "-2024-01-02", "12024-01-02", "0000-01-01", "0001-01-01", "29/02/2023", "29/02/2024", "29.02.2024",
        " 2024-02-03", "2024-02-03 ", "31/12/20245", "31/12/24", "٢٠٢٤-01-01", "é/-2024", "--", "//", "", "n/a", "not-a-date",
        "2024-12-31T00:00:00", "12--1-2024", None,
    ]
    df = rows("s string", *texts)
    layouts = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "dd.MM.yyyy", "d/M/yyyy", "MMM-yyyy-dd", "yyyyMMdd", "yyyy/MM/dd")
    for formats in (*((layout,) for layout in layouts), layouts, parse.ORDER_DATE_FORMATS, parse.SHIPMENT_DATE_FORMATS):
        tried = F.coalesce(*[F.try_to_date("s", layout) for layout in formats])
        assert df.where(~parse.parse_date(F.col("s"), formats).eqNullSafe(tried)).collect() == []

    def seconds(day):
        many = spark.range(0, 200_000, 1, 1).select(F.lit("31/12/20").alias("a"), (F.col("id") % 10 + 20).cast("string").alias("b"))
        dated = many.select(day(F.concat("a", "b")).alias("day"))
        best = []
        for _ in range(3):
            start = time.monotonic()
            assert dated.where(F.col("day").isNotNull()).count() == 200_000
            best.append(time.monotonic() - start)
        return min(best)

    second = seconds(lambda text: parse.parse_date(text, ("yyyy-MM-dd", "dd/MM/yyyy")))
    assert second < 2.5 * seconds(lambda text: parse.parse_date(text, ("dd/MM/yyyy",))) + 0.1


@pytest.mark.parametrize("money", ["decimal(18,2)", "double"])
def test_f14_customers_are_counted_once_for_region_table_and_summary(spark, folder, monkeypatch, rows, money):
    """The summary takes the region table's sales figures; months without a date or a delivery stay."""
    paths, plans = LayerPaths(folder), {}
    sales = rows(
        "order_id string, customer_id string, region string, product_category string, quantity int, sales_amount string, "
        "net_sales_amount string, discount double, order_year int, order_month int, order_quarter string",
        ("a", "x", "N", "p", 1, "10.05", "10.05", 0.0, 2024, 1, "Q1"), ("b", "x", "N", "p", 2, "20.10", "18.09", 10.0, 2024, 1, "Q1"),
        ("c", "y", "N", "p", 3, "1.00", "1.00", None, None, None, None), ("d", "z", "S", "p", 4, "0.00", "0.00", 0.0, 2023, 5, "Q2"),
        ("e", "z", None, "p", None, None, None, None, None, None, None),
    ).withColumns({c: F.col(c).cast(money) for c in ("sales_amount", "net_sales_amount")}).withColumn("discount", F.col("discount").cast("decimal(9,4)" if "decimal" in money else "double"))
    logistics = rows(
        "shipment_id string, order_id string, carrier string, freight_cost string, delivery_lead_time_days int, delivered_on_time boolean, status string",
        ("1", "a", "k", "2.50", 3, True, "X"), ("2", "a", "k", "1.25", 4, False, "X"), ("3", "c", "k", "9.99", None, None, "Y"), ("4", "e", "k", "1.00", 1, True, "Y"),
    ).withColumn("freight_cost", F.col("freight_cost").cast(money))
    layers.overwrite_table(sales, paths.silver("sales"), partition_cols=layers.SALES_PARTITIONS)
    layers.overwrite_table(logistics, paths.silver("logistics"), partition_cols=layers.LOGISTICS_PARTITIONS)
    real = layers.overwrite_table
    monkeypatch.setattr(layers, "overwrite_table", lambda df, path, *a, **k: plans.update({path: plan_of(df)}) or real(df, path, *a, **k))
    counts = layers.run_gold(spark, paths)
    assert "customer_id" in plans[paths.gold("sales_by_region")] and "customer_id" not in plans[paths.gold("executive_summary")]
    asked = kpi.executive_summary(*(layers.read_silver(spark, paths, t) for t in ("sales", "logistics")), one_row_per_order=True).drop("_gold_timestamp")
    stored = layers.read_table(spark, paths.gold("executive_summary")).select(asked.columns)
    assert values(stored) == values(asked) and counts["executive_summary"] == asked.count() == 4


def test_f16_stored_tables_take_fewer_bytes(spark, folder):
    """Silver shipments are an eighth of the bytes that a gold run moves."""
    sizes = {}
    shipments = registered.clean_logistics(spark, TABLES)
    shipments.write.partitionBy(*layers.LOGISTICS_PARTITIONS).parquet(f"{folder}/plain")
    layers.overwrite_table(shipments, f"{folder}/stored", partition_cols=layers.LOGISTICS_PARTITIONS, distribute=False)
    for name in ("plain", "stored"):
        sizes[name] = sum(f.stat().st_size for f in Path(f"{folder}/{name}".removeprefix("file://")).rglob("*.parquet"))
    assert sizes["stored"] < 0.9 * sizes["plain"]
    plain, stored = (spark.read.parquet(f"{folder}/{name}").drop("_silver_timestamp") for name in sizes)
    assert plain.exceptAll(stored).count() == 0 and stored.count() == plain.count() > 0
