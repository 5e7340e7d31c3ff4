"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import functions as fn
from strata import operators as op
from strata.operators import heavy, quality
from strata.plans import kpi, layers, refine, state
from strata.scratch import scratch_dir
from strata.session import get_session
from strata.sources import contracts, json_split, maintenance, partitions, readers, rescued, skipping, upsert, writers
from verification import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

EXACT = refine.EXACT_MONEY
LATER = timedelta(days=30)
FILE_BYTES = 1024 * 1024

GATE = ("read", "duplicates", "rejected", "total", "null_critical", "passed")
SALES_OUT = (
    "order_id", "order_date", "customer_id", "product_category", "region", "sales_amount",
    "quantity", "discount", "net_sales_amount", "order_year", "order_month", "order_quarter",
)
LOGISTICS_OUT = (
    "shipment_id", "order_id", "dispatch_date", "delivery_date", "carrier", "freight_cost",
    "status", "delivery_lead_time_days", "delivered_on_time",
)


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns (default: all but stamps), decimals as double."""
    names = columns or [c for c in df.columns if not c.startswith("_")]
    types = dict(df.dtypes)
    return df.select(
        *[
            F.col(c).cast("double").alias(c) if types[c].startswith("decimal") else F.col(c)
            for c in names
        ]
    )


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.refine_sales(fx.sales_raw(spark, sf_dir), money=EXACT)


def clean_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.refine_logistics(
        fx.logistics_raw(spark, sf_dir),
        money=EXACT,
        newest="_ingestion_timestamp",
        tie_breakers=fx.LOGISTICS_TIES,
    )


# Parsing and row-level expressions


def scl_parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.sales_raw(spark, sf_dir)
    return raw.select("order_id", fn.parse_money(F.col("sales_amount")).alias("sales_amount"))


def scl_parse_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.sales_raw(spark, sf_dir)
    return raw.select("order_id", fn.parse_percent(F.col("discount")).alias("discount"))


def scl_parse_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    line = F.col("l_linenumber")
    text = (
        F.when(line == 2, F.concat(F.lit(" "), price, F.lit("\t")))
        .when(line == 3, F.concat(F.lit("-"), price))
        .when(line == 4, F.lit("1e3"))
        .when(line == 5, F.concat(price, F.lit(" pcs")))
        .otherwise(price)
    )
    lines = fx.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", fn.parse_int(text).alias("whole"))


def scl_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.sales_raw(spark, sf_dir)
    return raw.select("order_id", fn.parse_date(F.col("order_date")).alias("order_date"))


def scl_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.sales_raw(spark, sf_dir)
    return op.normalize_text(raw, refine.SALES_TEXT).select("order_id", *refine.SALES_TEXT)


def scl_fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.sales_raw(spark, sf_dir).withColumn("discount", fn.parse_percent(F.col("discount")))
    filled = op.fill_defaults(raw, refine.SALES_DEFAULTS)
    return filled.select("order_id", *refine.SALES_DEFAULTS)


def scl_net_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, pct = F.col("l_extendedprice").cast(EXACT), F.col("l_discount") * 100
    pct = F.round(pct, 0).cast(refine.EXACT_PERCENT)
    net = fn.net_amount(price, pct, exact=True).cast("double")
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", net.alias("net"))


def scl_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", fx.blank_every(F.col("l_partkey"), 13, F.col("l_shipdate").cast("date")).alias("day")
    )
    return op.calendar_parts(days, "day", "ship").drop("day")


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = (fx.table(spark, sf_dir, t) for t in ("lineitem", "orders"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = fx.blank_every(F.col("l_partkey"), 13, F.col("l_shipdate").cast("date"))
    return joined.select(
        "l_orderkey", F.col("o_orderdate").cast("date").alias("ordered"), shipped.alias("shipped"),
        "l_linestatus",
    )


def scl_lead_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fn.lead_days(F.col("ordered"), F.col("shipped"))
    return _dated_lines(spark, sf_dir).select("l_orderkey", days.alias("days"))


def scl_sla_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fn.lead_days(F.col("ordered"), F.col("shipped"))
    return _dated_lines(spark, sf_dir).select("l_orderkey", fn.sla_flag(days, 90).alias("on_time"))


def scl_status_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fn.override_when_null(F.col("l_linestatus"), F.col("shipped"))
    return _dated_lines(spark, sf_dir).select("l_orderkey", status.alias("status"))


def scl_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = fx.blank_every(F.col("l_partkey"), 13, F.col("l_quantity") * 2)
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", fn.band(score).alias("band"))


# Filters, deduplication, joins


def flt_critical_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = op.require_not_null(fx.sales_raw(spark, sf_dir), refine.SALES_REQUIRED)
    return kept.select("order_id", "order_date", "quantity")


def ded_latest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = refine.latest_sales(fx.sales_raw(spark, sf_dir))
    return latest.select("order_id", "customer_id", fn.parse_money(F.col("sales_amount")).alias("amount"))


def ded_key_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    )
    return op.dedup_latest(lines, ["l_orderkey", "l_linenumber"])


def jon_left_sales_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipping = kpi.shipping_by_order(clean_logistics(spark, sf_dir))
    joined = op.enrich_left(clean_sales(spark, sf_dir), shipping, "order_id")
    return plain(
        joined, "order_id", "region", "net_sales_amount",
        "avg_lead_time", "total_freight_cost", "delivered_on_time",
    )


def jon_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderpriority"
    )
    lines = fx.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    aggs = [
        F.count("l_partkey").alias("lines"),
        F.sum(F.col("l_quantity").cast("decimal(12,0)")).cast("double").alias("quantity"),
        F.max("l_returnflag").alias("last_flag"),
    ]
    return op.preaggregate_then_left_join(orders, lines, "orderkey", aggs)


# Aggregations


def agg_bool_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = clean_logistics(spark, sf_dir)
    return shipments.groupBy("order_id").agg(
        fn.any_true(F.col("delivered_on_time")).alias("delivered_on_time")
    )


def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(spark, sf_dir).groupBy("region", "product_category").agg(
        fn.distinct("order_id").alias("orders"), fn.distinct("customer_id").alias("customers")
    )


def agg_first_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("dispatch_date"), F.col("shipment_id")]
    return clean_logistics(spark, sf_dir).groupBy("order_id").agg(
        fn.first_by(F.col("carrier"), order).alias("primary_carrier"),
        fn.first_by(F.col("status"), order).alias("shipment_status"),
    )


def agg_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = fn.ratio(F.sum("net_sales_amount"), fn.distinct("customer_id"), exact=True)
    return plain(
        clean_sales(spark, sf_dir).groupBy("region", "order_year").agg(
            per_customer.alias("revenue_per_customer")
        )
    )


def agg_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = fn.rate_pct(F.col("delivered_on_time"), F.count("shipment_id"), exact=True)
    return plain(clean_logistics(spark, sf_dir).groupBy("carrier").agg(rate.alias("on_time_pct")))


def agg_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.row_count(fx.table(spark, sf_dir, "lineitem"))


# Windows and sorts


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = clean_sales(spark, sf_dir).groupBy("region", "order_year", "order_month")
    return month.agg(fn.total(F.col("net_sales_amount")).alias("revenue"))


def win_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(op.rank_within(_monthly(spark, sf_dir), "revenue", kpi.MONTH, "place"))


def win_rank_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", F.col("l_extendedprice").alias("price")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return op.rank_within(lines, "price", ["l_linestatus"], "place", spread=tasks)


def win_mom_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        op.growth_pct(_monthly(spark, sf_dir), "revenue", ["region"], kpi.MONTH, "growth_pct")
    )


def win_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(op.share_of_total(_monthly(spark, sf_dir), "revenue", kpi.MONTH, "share_pct"))


def win_share_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast(EXACT).alias("price")
    )
    status = ["o_orderstatus"]
    return plain(op.share_of_total(orders, "price", status, "share_pct", scale=6, spread=True))


def srt_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("net_sales_amount").desc_nulls_last(), F.col("order_id")]
    return plain(op.preview(clean_sales(spark, sf_dir), order, 5), "order_id", "net_sales_amount")


# Data quality


def dq_null_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_gate(fx.sales_raw(spark, sf_dir), "region")


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(fx.sales_raw(spark, sf_dir))


def dq_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.dedup_stats(fx.logistics_raw(spark, sf_dir), ["shipment_id"])


def dq_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = refine.rejected_sales(fx.sales_raw(spark, sf_dir))
    return bad.select("order_id", F.array_join("_reject_reasons", ",").alias("reasons"))


# Sources, sinks and maintenance: written, read back, compared by content


def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "src-csv")
    fx.write_sales_csv(fx.sales_raw(spark, sf_dir), path)
    raw = readers.read_csv_contract(spark, path, contracts.SALES_CONTRACT, enforce_header=True)
    return raw.select(
        "order_id", "order_date", "customer_id", "product_category", "region", "quantity",
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "src-json")
    fx.write_logistics_json(fx.logistics_raw(spark, sf_dir), path)
    raw = readers.read_json_contract(spark, path, contracts.LOGISTICS_CONTRACT)
    return raw.select(
        "shipment_id", "order_id", "delivery_date", "carrier", "origin_city",
        F.col("freight_cost").cast("double").alias("freight_cost"), "status",
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "src-table")
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.lpad(F.col("l_linenumber").cast("string"), 3, "0").alias("code"),
    )
    writers.overwrite_table(lines, path, partition_cols=["code"])
    return readers.read_table(spark, path, text_partitions=["code"])


def snk_append_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "snk-append")
    orders = fx.table(spark, sf_dir, "orders")
    old = orders.select("o_orderkey", "o_orderstatus")
    writers.append_table(old, path)
    writers.append_table(orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return readers.read_table(spark, path)


def snk_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "snk-overwrite")
    sales = plain(clean_sales(spark, sf_dir), *SALES_OUT)
    parts = layers.SALES_PARTITIONS
    writers.overwrite_table(sales.select("order_id", *parts), path, partition_cols=parts)
    writers.overwrite_table(sales, path, partition_cols=parts)
    return readers.read_table(spark, path)


def _stored_lines(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_dir(spark, label)
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", "l_returnflag"
    )
    writers.append_table(lines, path, partition_cols=["l_returnflag"])
    return path


def mnt_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = _stored_lines(spark, sf_dir, "compact-src"), scratch_dir(spark, "compact-dst")
    maintenance.compact(spark, src, dst, target_bytes=FILE_BYTES, partition_cols=["l_returnflag"])
    return readers.read_table(spark, dst)


def mnt_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = _stored_lines(spark, sf_dir, "zorder-src"), scratch_dir(spark, "zorder-dst")
    maintenance.zorder(spark, src, dst, ["l_partkey", "l_shipdate", "l_returnflag"], target_bytes=FILE_BYTES)
    return readers.read_table(spark, dst)


def mnt_orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows held by files that the live version no longer reads."""
    root = scratch_dir(spark, "orphans")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for version in ("v1", "v2"):
        writers.append_table(
            orders.withColumn("version", F.lit(version)), f"{root}/{version}",
            partition_cols=["o_orderstatus"],
        )
    live = maintenance.data_files(spark, f"{root}/v2")
    orphans = maintenance.orphan_files(spark, root, live, as_of=datetime.now() + LATER)
    stored = spark.read.option("recursiveFileLookup", True).parquet(root)
    held = stored.select("version", F.col("_metadata.file_path").alias("path"))
    # One small row per file of the other side; aggregate first, then match files.
    per_file = held.groupBy("path", "version").agg(F.count(F.lit(1)).alias("n"))
    return per_file.join(orphans.select("path"), "path", "left_semi").groupBy("version").agg(
        F.sum("n").alias("orphan_rows")
    )


def prj_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = op.with_audit(fx.table(spark, sf_dir, "orders"), "bronze", fx.CURRENT_BATCH)
    dated = op.with_ingestion_year(audited, fx.CURRENT_BATCH)
    return dated.select(
        "o_orderkey", "_layer", "_year",
        F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested"),
        F.col("_source_file").contains("orders").alias("from_orders"),
    )


# Composite plans


def pip_sales_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(clean_sales(spark, sf_dir), *SALES_OUT)


def pip_logistics_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(clean_logistics(spark, sf_dir), *LOGISTICS_OUT)


def kpi_sales_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(kpi.sales_by_region(clean_sales(spark, sf_dir), one_row_per_order=True))


def kpi_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(kpi.sales_by_category(clean_sales(spark, sf_dir), one_row_per_order=True))


def kpi_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(kpi.logistics_kpi(clean_logistics(spark, sf_dir)))


def kpi_executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, logistics = clean_sales(spark, sf_dir), clean_logistics(spark, sf_dir)
    return plain(kpi.executive_summary(sales, logistics, one_row_per_order=True))


def _run_bronze(spark: SparkSession, sf_dir: str) -> contracts.LayerPaths:
    """Three ingestions of the same two folders: stale files, current ones beside them, nothing new."""
    paths = contracts.LayerPaths(scratch_dir(spark, "layers"))
    sales, shipments = fx.sales_raw(spark, sf_dir), fx.logistics_raw(spark, sf_dir)
    stale = F.col("_tb1") % 2 == 0  # by part number
    for name, batch, rows in (("stale", fx.STALE_BATCH, stale), ("current", fx.CURRENT_BATCH, ~stale), ("again", fx.CURRENT_BATCH, None)):
        if rows is not None:
            fx.write_sales_csv(sales.filter(F.col("_ingestion_timestamp") == F.lit(batch)), f"{paths.raw('sales')}/{name}")
            fx.write_logistics_json(shipments.filter(rows), f"{paths.raw('logistics')}/{name}")
        layers.run_bronze(spark, paths, paths.raw("sales"), paths.raw("logistics"), only_new_files=True, as_of=batch)
    return paths


def pip_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _run_bronze(spark, sf_dir)
    sales = readers.read_table(spark, paths.bronze("sales"))
    logistics = readers.read_table(spark, paths.bronze("logistics"))

    def held(table: str, df: DataFrame, key: str) -> DataFrame:
        day = F.date_format("_ingestion_timestamp", "yyyy-MM-dd").alias("ingested")
        return df.select(F.lit(table).alias("source"), F.col(key).alias("id"), day, "_layer", "_year")

    return held("sales", sales, "order_id").unionByName(
        held("logistics", logistics, "shipment_id")
    )


def pip_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _run_bronze(spark, sf_dir)
    layers.run_silver(spark, paths)
    return plain(layers.read_silver(spark, paths, "sales"), *SALES_OUT)


def pip_silver_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of two ingestions wins, then the raw text."""
    paths = _run_bronze(spark, sf_dir)
    layers.run_silver(spark, paths)
    return plain(layers.read_silver(spark, paths, "logistics"), *LOGISTICS_OUT)


def pip_silver_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and gates of a silver run: one within its limit, one not."""
    paths = _run_bronze(spark, sf_dir)
    gates = layers.run_silver(spark, paths, max_null_pct=1.0)
    rows = [(name, *(gate[c] for c in GATE)) for name, gate in gates.items()]
    return spark.createDataFrame(rows, "name string, read long, duplicates long, rejected long, total long, null_critical long, passed boolean")


def pip_silver_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the silver run drops or blanks of bronze, with the reasons."""
    paths = _run_bronze(spark, sf_dir)
    raw = readers.read_table(spark, paths.bronze("sales"), schema=contracts.bronze_schema(contracts.SALES_CONTRACT))
    bad = refine.rejected_sales(raw, money=EXACT)
    return bad.select("order_id", F.array_join("_reject_reasons", ",").alias("reasons"))


def _stored_silver(spark: SparkSession, sf_dir: str) -> contracts.LayerPaths:
    paths = contracts.LayerPaths(scratch_dir(spark, "layers"))
    tables = {
        "sales": (clean_sales(spark, sf_dir), layers.SALES_PARTITIONS, True),
        "logistics": (clean_logistics(spark, sf_dir), layers.LOGISTICS_PARTITIONS, False),
    }
    layers.together(
        {
            table: partial(writers.overwrite_table, df, paths.silver(table), partition_cols=parts, distribute=distribute)
            for table, (df, parts, distribute) in tables.items()
        }
    )
    return paths


def _run_gold(spark: SparkSession, sf_dir: str) -> contracts.LayerPaths:
    paths = _stored_silver(spark, sf_dir)
    layers.run_gold(spark, paths)
    return paths


def pip_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four gold tables, read back as one long listing of their revenue and volume."""
    paths = _run_gold(spark, sf_dir)

    def gold(table: str) -> DataFrame:
        return readers.read_table(spark, paths.gold(table))

    def line(table: str, label: str, period: str, money: str, count: str) -> DataFrame:
        return gold(table).select(
            F.lit(table).alias("gold_table"),
            F.col(label).alias("label"),
            F.expr(period).alias("period"),
            F.col(money).cast("double").alias("money"),
            F.col(count).alias("items"),
        )

    month = "order_year * 12 + order_month"
    return (
        line("sales_by_region", "region", month, "total_net_revenue", "total_orders")
        .unionByName(
            line(
                "sales_by_category", "product_category",
                "order_year * 4 + CAST(substring(order_quarter, 2) AS INT)",
                "total_net_revenue", "total_orders",
            )
        )
        .unionByName(
            line("logistics_kpi", "carrier", "length(status)", "total_freight_cost", "total_shipments")
        )
        .unionByName(
            line("executive_summary", "region", month, "total_freight_cost", "total_units_sold")
        )
    )


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    paths = _run_gold(spark, sf_dir)
    return plain(readers.read_table(spark, paths.gold(table), text_partitions=["status"]))


def pip_gold_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "sales_by_region")


def pip_gold_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "sales_by_category")


def pip_gold_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "logistics_kpi")


def pip_gold_executive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "executive_summary")


def cch_gold_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold run on cached sales: rows of each table."""
    paths = _stored_silver(spark, sf_dir)
    counts = layers.run_gold(spark, paths, cache_level=StorageLevel.MEMORY_AND_DISK)
    return spark.createDataFrame(sorted(counts.items()), "gold_table string, n long")


def prj_layer_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit columns after a second layer has stamped the rows, in the session's time zone."""
    bronze = op.with_audit(fx.table(spark, sf_dir, "orders"), "bronze", fx.STALE_BATCH)
    silver = op.stamp_layer(bronze, "silver", fx.CURRENT_BATCH)
    stamp = "yyyy-MM-dd HH:mm:ss"
    return silver.select(
        "o_orderkey", "_layer",
        F.date_format("_ingestion_timestamp", stamp).alias("ingested"),
        F.date_format("_silver_timestamp", stamp).alias("refined"),
    )


def src_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the session factory gives: settings, and a moment of each order in the session's time zone."""
    session = get_session("strata-check")
    names = ["spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"]
    settings = "|".join(session.conf.get(n) for n in names)
    orders = fx.table(session, sf_dir, "orders")
    moment = F.timestamp_seconds(F.col("o_orderkey") * 86_400 + 3_600)
    # By number: ``yyyy`` puts a plus before years of five digits.
    year = F.year(moment)
    digits = F.when(year.between(0, 999), F.lpad(year.cast("string"), 4, "0")).otherwise(year.cast("string"))
    shown = F.concat(digits, F.date_format(moment, "-MM-dd HH:mm"))
    return orders.select("o_orderkey", shown.alias("moment"), F.lit(settings).alias("settings"))


# Incremental tables and joins


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as first stored, and later changes: late, moved, repeated and new ones."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    orders = fx.table(spark, sf_dir, "orders").select(k.alias("k"), day.alias("day"), F.col("o_totalprice").cast(EXACT).alias("price"), F.lit(10).alias("version"))
    dated = orders.select("*", F.year("day").alias("order_year"), F.month("day").alias("order_month"))
    first = dated.where("k % 97 <> 4")
    kind = F.col("k") % 97
    moved = dated.where("k % 97 < 5").select(
        "k",
        F.when(kind == 1, F.add_months("day", 2)).otherwise(F.col("day")).alias("day"),
        F.when(kind == 3, F.col("price")).otherwise(F.col("price") * 2).cast(EXACT).alias("price"),
        F.when(kind == 0, 5).when(kind == 3, 10).otherwise(11).alias("version"),
    )
    twice = moved.unionByName(moved.where("k % 97 = 1").withColumn("version", F.lit(12)).withColumn("price", F.lit(1).cast(EXACT)))
    return first, twice.select("*", F.year("day").alias("order_year"), F.month("day").alias("order_month"))


def snk_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after an upsert of late, moved, repeated and new orders, half of them at a time."""
    path = scratch_dir(spark, "upsert")
    first, changes = _versions(spark, sf_dir)
    writers.overwrite_table(first, path, partition_cols=layers.SALES_PARTITIONS)
    for half in ("k % 2 = 0", "k % 2 = 1"):
        upsert.upsert_latest(spark, changes.where(half), path, ["k"], "version", layers.SALES_PARTITIONS)
    return plain(readers.read_table(spark, path))


def _kpi_refreshed(spark: SparkSession, sf_dir: str) -> contracts.LayerPaths:
    """The state of silver without and then with a sixth of its months' orders."""
    paths = contracts.LayerPaths(scratch_dir(spark, "state"))
    parts = layers.SALES_PARTITIONS
    cleaned = scratch_dir(spark, "sales")  # cleaned once; by month, so that its months are a listing
    writers.overwrite_table(clean_sales(spark, sf_dir), cleaned, partition_cols=parts)
    sales = readers.read_table(spark, cleaned, merge_schema=False)
    changed = F.coalesce(F.col("order_month") % 6 == 1, F.lit(False))
    writers.overwrite_table(
        clean_logistics(spark, sf_dir), paths.silver("logistics"), partition_cols=layers.LOGISTICS_PARTITIONS, distribute=False
    )
    writers.overwrite_table(sales.where(~changed | (F.col("quantity") > 5)), paths.silver("sales"), partition_cols=parts)
    state.refresh_state(spark, paths)
    months = [m for m in partitions.partitions_of(sales, parts) if m[1] is not None and m[1] % 6 == 1]
    partitions.replace_partitions(sales.where(changed), paths.silver("sales"), parts, months)
    state.refresh_state(spark, paths, months)
    return paths


def kpi_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(state.sales_by_region(spark, _kpi_refreshed(spark, sf_dir)))


def kpi_refresh_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(state.sales_by_category(spark, _kpi_refreshed(spark, sf_dir)))


def kpi_refresh_executive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(state.executive_summary(spark, _kpi_refreshed(spark, sf_dir)))


def agg_distinct_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct customers by year and region; are those of merged monthly sketches within 5 %."""
    sales = clean_sales(spark, sf_dir).where("order_year is not null")
    months = sales.groupBy("region", "order_year", "order_month").agg(
        fn.distinct("customer_id").alias("exact"), fn.distinct_sketch("customer_id").alias("sketch")
    )
    merged = months.groupBy("region", "order_year").agg(fn.merged_distinct("sketch").alias("estimate"))
    whole = sales.groupBy("region", "order_year").agg(fn.distinct("customer_id").alias("customers"))
    close = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1.0), F.col("customers") * 0.05)
    return whole.join(merged, ["region", "order_year"]).select("region", "order_year", "customers", close.alias("in_band"))


def jon_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which half belong to one supplier, with the supplier's parts (broadcast) summed."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_suppkey")).cast("long").alias("s_suppkey")
    )
    suppliers = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return heavy.join_heavy(lines, suppliers, "s_suppkey")


def jon_heavy_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a side that is too large to be broadcast."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_partkey")).cast("long").alias("p_partkey")
    )
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = heavy.join_heavy(lines, parts, "p_partkey", "inner", heavy.Heavy(broadcast_bytes=0))
    return joined.groupBy("p_partkey", "p_name").agg(F.count("*").alias("n"))


def kpi_executive_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The executive summary of silver tables that are bucketed by order."""
    name = f"t{uuid4().hex}"
    tables = {"sales": clean_sales(spark, sf_dir), "logistics": clean_logistics(spark, sf_dir)}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = {t: writers.write_bucketed(df, f"{name}_{t}", scratch_dir(spark, f"bucketed-{t}"), ["order_id"], buckets) for t, df in tables.items()}
    return plain(kpi.executive_summary(stored["sales"], stored["logistics"], one_row_per_order=True))


def mnt_skip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a two-column range read through file statistics, and whether these left out files rightly."""
    src, dst, stats = _stored_lines(spark, sf_dir, "skip-src"), scratch_dir(spark, "skip-dst"), scratch_dir(spark, "skip-stats")
    maintenance.zorder(spark, src, dst, ["l_partkey", "l_orderkey"], target_bytes=64 * 1024, partition_cols=())
    skipping.write_file_stats(spark, dst, ["l_partkey", "l_orderkey"], stats)
    first, last = spark.read.parquet(dst).agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    ranges = {"l_partkey": (1, 40), "l_orderkey": (first, first + (last - first) // 4)}
    rows = skipping.read_ranges(spark, dst, stats, ranges)
    inside = F.col("l_partkey").between(*ranges["l_partkey"]) & F.col("l_orderkey").between(*ranges["l_orderkey"])
    held = spark.read.parquet(dst).where(inside).select(F.col("_metadata.file_path").alias("file")).distinct()
    kept = skipping.kept_files(spark, stats, ranges)
    lost = held.select(F.url_decode("file").alias("path")).join(kept, "path", "left_anti").count()
    fewer = kept.count() < spark.read.parquet(stats).count() or kept.count() <= 1
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.lit(lost == 0).alias("complete"), F.lit(fewer).alias("fewer"))


def src_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array in a single file, read by several tasks."""
    path = scratch_dir(spark, "json-array")
    customers = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("shipment_id"),
        F.concat(F.lit('}"{,\\['), "c_name", F.lit('\n]"')).alias("order_id"),
        F.col("c_mktsegment").alias("carrier"),
        F.struct(F.lit("}").alias("a"), F.array(F.lit('"')).alias("b")).alias("more"),
    )
    fx.write_json_array(customers, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        raw = json_split.read_json_array(spark, path, contracts.LOGISTICS_CONTRACT)
        out = scratch_dir(spark, "json-read")
        raw.write.parquet(out)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    corrupt = F.col("_corrupt_record").isNotNull().alias("corrupt")
    return spark.read.parquet(out).select("shipment_id", "order_id", "carrier", "status", corrupt)


def src_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with extra, missing and renamed fields, values of another shape, and broken text."""
    path = scratch_dir(spark, "rescued")
    k = F.col("c_custkey")
    record = F.to_json(
        F.struct(
            F.when(k % 5 != 0, k.cast("string")).alias("shipment_id"),
            F.when(k % 3 == 0, F.col("c_name")).alias("CARRIER"),
            F.when(k % 3 == 1, F.col("c_name")).alias("haulier"),
            F.when(k % 7 == 0, F.struct(F.lit(1).alias("x"))).alias("status"),
            F.when(k % 11 == 0, F.col("c_mktsegment")).alias("segment"),
        )
    )
    text = F.when(k % 13 == 0, F.concat(F.lit("{broken "), k.cast("string"))).otherwise(record)
    fx.table(spark, sf_dir, "customer").select(text.alias("value")).write.text(path)
    raw = rescued.read_json_rescued(spark, path, contracts.LOGISTICS_CONTRACT, renamed={"haulier": "carrier"})
    return raw.select("shipment_id", "carrier", "status", F.to_json(rescued.RESCUED).alias("rescued"), "_corrupt_record")


def src_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table under a contract: cast, renamed by case, completed, in order."""
    path = scratch_dir(spark, "conform")
    orders = fx.table(spark, sf_dir, "orders")
    orders.select("o_orderpriority", F.col("o_orderkey").cast("string").alias("O_ORDERKEY"), "o_orderstatus").write.parquet(path)
    contract = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.IntegerType()), T.StructField("o_note", T.StringType())])
    return readers.read_table(spark, path, contract=contract)


ALL: tuple[Query, ...] = (
    scl_parse_money, scl_parse_percent, scl_parse_int, scl_parse_date, scl_normalize_text,
    scl_fill_defaults, scl_net_amount, scl_calendar, scl_lead_days, scl_sla_flag,
    scl_status_override, scl_band,
    flt_critical_not_null, ded_latest_sales, ded_key_logistics,
    jon_left_sales_logistics, jon_preagg,
    agg_bool_or, agg_count_distinct, agg_first_by, agg_ratio, agg_rate, agg_row_count,
    win_rank, win_rank_spread, win_mom_growth, win_share, win_share_spread, srt_preview,
    dq_null_gate, dq_profile, dq_dedup_stats, dq_rejected,
    src_csv, src_json, src_table, snk_append_merge_schema, snk_overwrite_roundtrip,
    mnt_compact, mnt_zorder, mnt_orphan_files, prj_audit,
    pip_sales_clean, pip_logistics_clean, pip_bronze, pip_silver, pip_silver_logistics, pip_gold,
    kpi_sales_by_region, kpi_sales_by_category, kpi_logistics, kpi_executive_summary,
    pip_silver_gate, pip_silver_rejected, pip_gold_region, pip_gold_category, pip_gold_logistics,
    pip_gold_executive, cch_gold_cached, prj_layer_stamp, src_session, snk_upsert,
    kpi_refresh, kpi_refresh_category, kpi_refresh_executive, agg_distinct_sketch, jon_heavy,
    jon_heavy_salted, kpi_executive_colocated, mnt_skip_files, src_json_split, src_rescued, src_conform,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in ALL}
