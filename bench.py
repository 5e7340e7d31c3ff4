"""Time the headline work on stored layer tables; prints one JSON line.

Raw files are derived from the tables of ``BENCH_SF_DIR`` first, untimed. Then
each layer run and each query on the stored layers runs once to warm up and
once timed. Queries go to Spark's ``noop`` sink: every output column is
computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata import functions as fn  # noqa: E402
from strata import operators as op  # noqa: E402
from strata.plans import kpi, layers, refine  # noqa: E402
from strata.session import tune  # noqa: E402
from strata.sources import LayerPaths, compact, read_table, scratch_dir, zorder  # noqa: E402
from verification import fixtures as fx  # noqa: E402


FILE_BYTES = 1024 * 1024


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def layer_runs(spark: SparkSession, sf_dir: str) -> tuple[LayerPaths, dict[str, Callable[[], object]]]:
    paths = LayerPaths(scratch_dir(spark, "bench"))
    fx.write_sales_csv(fx.sales_raw(spark, sf_dir), paths.raw("sales"))
    fx.write_logistics_json(fx.logistics_raw(spark, sf_dir), paths.raw("logistics"))
    raw = (paths.raw("sales"), paths.raw("logistics"))

    def bronze() -> None:
        layers.run_bronze(spark, LayerPaths(scratch_dir(spark, "bench-bronze")), *raw)

    layers.run_bronze(spark, paths, *raw)
    return paths, {
        "pip_bronze": bronze,
        "pip_silver": partial(layers.run_silver, spark, paths),
        "pip_gold": partial(layers.run_gold, spark, paths),
    }


def queries(spark: SparkSession, paths: LayerPaths) -> dict[str, Callable[[], DataFrame]]:
    raw_sales = read_table(spark, paths.bronze("sales"))
    raw_logistics = read_table(spark, paths.bronze("logistics"))
    sales = layers.read_silver(spark, paths, "sales")
    logistics = layers.read_silver(spark, paths, "logistics")
    grain = {"one_row_per_order": True}
    net = F.col("net_sales_amount")

    def monthly() -> DataFrame:
        return sales.groupBy("region", *kpi.MONTH).agg(fn.total(net).alias("revenue"))

    return {
        "ded_latest_sales": lambda: refine.latest_sales(raw_sales),
        "ded_key_logistics": lambda: refine.latest_logistics(raw_logistics),
        "pip_sales_clean": lambda: refine.refine_sales(raw_sales),
        "pip_logistics_clean": lambda: refine.refine_logistics(raw_logistics),
        "jon_left_sales_logistics": lambda: op.enrich_left(
            sales, kpi.shipping_by_order(logistics), "order_id"
        ),
        "win_rank": lambda: op.rank_within(monthly(), "revenue", kpi.MONTH, "place"),
        "win_rank_spread": lambda: op.rank_within(
            sales.select("order_id", "order_year", "net_sales_amount"),
            "net_sales_amount", ["order_year"], "place", spread=int(spark.conf.get("spark.sql.shuffle.partitions")),
        ),
        "win_mom_growth": lambda: op.growth_pct(monthly(), "revenue", ["region"], kpi.MONTH, "g"),
        "win_share": lambda: op.share_of_total(monthly(), "revenue", kpi.MONTH, "share"),
        "dq_profile": lambda: op.profile(raw_sales),
        "dq_null_gate": lambda: op.null_gate(logistics, "shipment_id"),
        "dq_dedup_stats": lambda: op.dedup_stats(raw_logistics, ["shipment_id"]),
        "kpi_sales_by_region": lambda: kpi.sales_by_region(sales, **grain),
        "kpi_sales_by_category": lambda: kpi.sales_by_category(sales, **grain),
        "kpi_logistics": lambda: kpi.logistics_kpi(logistics),
        "kpi_executive_summary": lambda: kpi.executive_summary(sales, logistics, **grain),
    }


def rewrites(spark: SparkSession, paths: LayerPaths) -> dict[str, Callable[[], None]]:
    src = paths.silver("sales")

    def compaction() -> None:
        dst = scratch_dir(spark, "bench-compact")
        compact(spark, src, dst, target_bytes=FILE_BYTES, partition_cols=["order_year"])

    def clustering() -> None:
        zorder(spark, src, scratch_dir(spark, "bench-z"), ["region", "order_date"], target_bytes=FILE_BYTES)

    return {"mnt_compact": compaction, "mnt_zorder": clustering}


def timed(work: Callable[[], object]) -> float:
    work()
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def drained(build: Callable[[], DataFrame]) -> Callable[[], None]:
    return lambda: build().write.format("noop").mode("overwrite").save()


def scale_factor(sf_dir: str) -> float | str:
    name = Path(sf_dir).name.removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    paths, runs = layer_runs(spark, sf_dir)
    seconds = {name: timed(work) for name, work in runs.items()}
    seconds |= {name: timed(drained(q)) for name, q in queries(spark, paths).items()}
    seconds |= {name: timed(work) for name, work in rewrites(spark, paths).items()}
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": scale_factor(sf_dir),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
