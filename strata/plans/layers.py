"""Layer runs: files to bronze, bronze to silver, silver to gold tables.

These run jobs. Row counts ride on each write as observed metrics, so a table
is computed once and the counts describe what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial
from typing import TypeVar

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.audit import with_audit, with_ingestion_year
from strata.operators.caching import cached
from strata.operators.quality import MAX_NULL_PCT, gate_metrics
from strata.plans import kpi, refine
from strata.scratch import scratch_dir, scratch_scope
from strata.sources import contracts, manifest
from strata.sources.contracts import LayerPaths
from strata.sources.readers import read_csv_contract, read_json_contract, read_table
from strata.sources.writers import append_table, overwrite_table

# Partition columns of the stored tables.
BRONZE_PARTITIONS = ("_year",)
SALES_PARTITIONS = ("order_year", "order_month")
LOGISTICS_PARTITIONS = ("status",)
GOLD_PARTITIONS = ("order_year",)

Result = TypeVar("Result")


def together(jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Submit independent writes at once, so one's last tasks overlap with the next one's first."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}


def _rows() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")]


def ingest(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Audit columns and ingestion year for a freshly scanned raw input."""
    return with_ingestion_year(with_audit(df, "bronze", as_of), as_of)


def run_bronze(
    spark: SparkSession,
    paths: LayerPaths,
    sales_csv: str | Sequence[str],
    logistics_json: str | Sequence[str],
    *,
    fmt: str = "parquet",
    multi_line: bool = True,
    enforce_header: bool = False,
    only_new_files: bool = False,
    as_of: datetime | None = None,
) -> dict[str, int]:
    """Append both raw inputs to bronze; returns the rows appended per table.

    Running twice appends twice (the silver dedup absorbs it) unless
    ``only_new_files``: then the inputs are listed, files in the manifest of
    earlier such runs are left out, and only the others are scanned. A run
    without new files scans nothing.
    """
    reads = {
        "sales": (sales_csv, partial(read_csv_contract, contract=contracts.SALES_CONTRACT, enforce_header=enforce_header)),
        "logistics": (logistics_json, partial(read_json_contract, contract=contracts.LOGISTICS_CONTRACT, multi_line=multi_line)),
    }

    def append(table: str) -> int:
        inputs, read = reads[table]
        if not only_new_files:
            return _append(ingest(read(spark, inputs), as_of), paths.bronze(table), fmt)
        with scratch_scope(spark):  # the list that is read is the list that is recorded
            files = manifest.store_new_files(spark, inputs, paths.manifest(table), scratch_dir(spark, "listing"))
            new = manifest.paths_of(files)
            if not new:
                return 0
            rows = _append(ingest(read(spark, new), as_of), paths.bronze(table), fmt)
            manifest.record_files(files, paths.manifest(table), as_of)
            return rows

    return together({table: partial(append, table) for table in reads})


def _append(df: DataFrame, path: str, fmt: str) -> int:
    seen = Observation()
    append_table(df, path, fmt, partition_cols=BRONZE_PARTITIONS, watch=(seen, _rows()))
    return seen.get["rows"]


def _gated_overwrite(
    raw: DataFrame,
    plan: refine.Refined,
    path: str,
    fmt: str,
    partition_cols: Sequence[str],
    critical: Sequence[str],
    max_null_pct: float,
    distribute: bool,
) -> dict[str, object]:
    read, seen, kept = raw.count(), Observation(), Observation()
    latest = plan.latest.observe(kept, F.count(F.lit(1)).alias("latest"), F.count_if(plan.dropped).alias("rejected"))
    overwrite_table(
        plan.finish(latest), path, fmt, partition_cols=partition_cols, distribute=distribute, watch=(seen, gate_metrics(*critical))
    )
    counts = {**kept.get, **seen.get}
    if counts["latest"] != counts["rejected"] + counts["total"]:  # tasks ran twice
        counts |= plan.latest.agg(F.count(F.lit(1)).alias("latest"), F.count_if(plan.dropped).alias("rejected")).first().asDict()
        counts["total"] = counts["latest"] - counts["rejected"]
    pct = 100.0 * counts["null_critical"] / counts["total"] if counts["total"] else 0.0
    duplicates = read - counts.pop("latest")
    return {"read": read, "duplicates": duplicates, **counts, "null_pct": pct, "passed": pct <= max_null_pct}


def run_silver(
    spark: SparkSession,
    paths: LayerPaths,
    *,
    fmt: str = "parquet",
    money: str = refine.EXACT_MONEY,
    merge_schema: bool = True,
    max_null_pct: float = MAX_NULL_PCT,
    sales_ties: Sequence[Column | str] | None = None,
    logistics_newest: str | None = refine.INGESTED,
    logistics_ties: Sequence[Column | str] | None = None,
    as_of: datetime | None = None,
) -> dict[str, dict[str, object]]:
    """Rebuild both silver tables; returns each table's figures and gate.

    Of the rows ``read``, some are ``duplicates`` of newer ones, some are
    ``rejected`` for missing required values, and ``total`` are written. The
    gate looks at what was written: ``null_critical`` rows have no key, or an
    amount or date that was there and could not be read, and ``passed`` says
    whether their share is within ``max_null_pct``. It reports and does not
    block. Amounts are decimal, so that sums do not depend on their order;
    ``money="double"`` is there for readers that need it. With
    ``merge_schema`` columns that some ingestions added reach silver, at the
    price of opening every bronze file once more; without it the contracts'
    columns are read directly.
    """

    def bronze(table: str, contract: T.StructType) -> DataFrame:
        schema = None if merge_schema else contracts.bronze_schema(contract)
        stored = read_table(spark, paths.bronze(table), fmt, schema=schema)
        return stored.drop(contracts.CORRUPT_COLUMN)

    raw = {"sales": bronze("sales", contracts.SALES_CONTRACT), "logistics": bronze("logistics", contracts.LOGISTICS_CONTRACT)}
    plans = {
        "sales": refine.plan_sales(raw["sales"], money=money, tie_breakers=sales_ties, as_of=as_of),
        "logistics": refine.plan_logistics(
            raw["logistics"], money=money, newest=logistics_newest, tie_breakers=logistics_ties, as_of=as_of
        ),
    }
    # A status is a third of all rows: the tasks' own files are even, a shuffle by it is not needed.
    stored = {
        "sales": (SALES_PARTITIONS, refine.SALES_CRITICAL, True),
        "logistics": (LOGISTICS_PARTITIONS, refine.LOGISTICS_CRITICAL, False),
    }
    return together(
        {
            table: partial(_gated_overwrite, raw[table], plans[table], paths.silver(table), fmt, parts, critical, max_null_pct, distribute)
            for table, (parts, critical, distribute) in stored.items()
        }
    )


def read_silver(spark: SparkSession, paths: LayerPaths, table: str, fmt: str = "parquet") -> DataFrame:
    """Silver table with its text partition column kept as text."""
    text = {"sales": (), "logistics": LOGISTICS_PARTITIONS}[table]
    return read_table(
        spark, paths.silver(table), fmt, merge_schema=False, text_partitions=text
    )


def run_gold(
    spark: SparkSession,
    paths: LayerPaths,
    *,
    fmt: str = "parquet",
    cache_level: StorageLevel | None = None,
    one_row_per_order: bool = True,
    rank_spread: int | None = None,
    share_spread: bool = False,
    as_of: datetime | None = None,
) -> dict[str, int]:
    """Rebuild the four KPI tables; returns the rows written per table.

    ``one_row_per_order`` holds for silver sales written by ``run_silver``.
    ``rank_spread`` and ``share_spread`` are those of the KPI plans, for regions
    and categories that are free text.

    Three jobs read sales. By default each rescans the few columns it uses,
    which holds at any table size; ``cache_level`` keeps those columns cached
    for the run instead, where they fit the cluster's storage memory. The cache
    is filled before the tables are computed, which they are at the same time;
    the executive summary then joins the stored region table with the delivery figures.
    """
    used = (
        "region", "product_category", "order_year", "order_month", "order_quarter",
        "order_id", "customer_id", "sales_amount", "net_sales_amount", "discount", "quantity",
    )
    logistics = read_silver(spark, paths, "logistics", fmt)
    grain = {"one_row_per_order": one_row_per_order, "as_of": as_of}

    def save(table: str, df: DataFrame, partition_cols: Sequence[str]) -> int:
        seen = Observation()
        overwrite_table(
            df, paths.gold(table), fmt, partition_cols=partition_cols, watch=(seen, _rows())
        )
        return seen.get["rows"]

    stored = read_silver(spark, paths, "sales", fmt).select(*used)
    with scratch_scope(spark), cached(stored, cache_level, materialize=True) as sales:
        delivery, delivered = kpi.delivery_by_region(sales, logistics), scratch_dir(spark, "delivery")
        by_region = kpi.sales_by_region(sales, rank_spread=rank_spread, **grain)
        plans = {
            "sales_by_region": (by_region, GOLD_PARTITIONS),
            "sales_by_category": (kpi.sales_by_category(sales, share_spread=share_spread, **grain), GOLD_PARTITIONS),
            "logistics_kpi": (kpi.logistics_kpi(logistics, as_of=as_of), ()),
        }
        jobs = {table: partial(save, table, df, parts) for table, (df, parts) in plans.items()}
        counts = together({"delivery": partial(delivery.write.parquet, delivered), **jobs})
        del counts["delivery"]
        # The summary's sales figures are the region table's: no second distinct count of customers.
        regions = read_table(spark, paths.gold("sales_by_region"), fmt, schema=by_region.schema if fmt == "parquet" else None)
        summary = kpi.executive_on_regions(regions, spark.read.schema(delivery.schema).parquet(delivered), as_of=as_of)
        return {**counts, "executive_summary": save("executive_summary", summary, GOLD_PARTITIONS)}
