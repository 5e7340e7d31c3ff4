"""Gold tables from stored partial aggregates, refreshed month by month.

Three of the KPI tables are sums, counts and distinct counts over orders. For each month
the state keeps these in mergeable form, by region and category: sums and counts in one
table, and which customers bought as bitmaps in another (one row for each 32,768 customer
numbers). Bitmaps of several months, regions or categories are OR-ed, so distinct customers
stay exact over any of them. A changed month is read and aggregated anew; all other months
keep their files, and the KPI tables follow from the state alone.

Amounts must be decimal: sums of doubles depend on their order, and a refreshed table would
not equal a rebuilt one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import is_exact, ratio
from strata.operators.audit import stamp_layer
from strata.operators.joins import preaggregate_then_left_join
from strata.operators.numbering import add_numbers
from strata.operators.windows import growth_pct, rank_within, share_of_total
from strata.plans import kpi
from strata.sources.contracts import LayerPaths
from strata.sources.partitions import Partition, in_partitions, partitions_of, replace_partitions
from strata.sources.readers import read_table

GRAIN = ("region", "product_category", "order_quarter")

# What each sum of the state adds up, as SQL over orders with their shipping.
SUMS = {
    "net": "sum(net_sales_amount)",
    "net_n": "count(net_sales_amount)",
    "gross": "sum(sales_amount)",
    "gross_n": "count(sales_amount)",
    "discount": "sum(discount)",
    "discount_n": "count(discount)",
    "units": "sum(quantity)",
    "orders": "count(order_id)",
    "lead": "sum(avg_lead_time)",
    "lead_n": "count(avg_lead_time)",
    "freight": "sum(total_freight_cost)",
    "on_time": "sum(cast(delivered_on_time as int))",
}


def _path(paths: LayerPaths, name: str) -> str:
    return paths.gold(f"_state/{name}")


def month_sums(orders: DataFrame) -> DataFrame:
    """Sums and counts per month, region and category; nulls of all three are groups."""
    sums = [F.expr(sql).alias(name) for name, sql in SUMS.items()]
    return orders.groupBy(*GRAIN, *kpi.MONTH).agg(*sums)


def month_customers(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the customers per month, region and category."""
    numbered = orders.join(numbers, F.col("customer_id") == F.col("value"))
    bit = F.col("number") + 1
    return numbered.groupBy(*GRAIN, *kpi.MONTH, F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("customers")
    )


def refresh_state(
    spark: SparkSession, paths: LayerPaths, months: Sequence[Partition] | None = None, *, fmt: str = "parquet"
) -> list[Partition]:
    """Aggregate ``months`` of silver sales anew (default: all); returns the months written.

    Only these months' partitions of sales are scanned. Of the shipments, those of the
    months' orders count; they are not stored by month, so their scan is filtered by join.
    A month without orders any more leaves the state.
    """
    sales = read_table(spark, paths.silver("sales"), fmt, merge_schema=False)
    logistics = read_table(spark, paths.silver("logistics"), fmt, merge_schema=False, text_partitions=("status",))
    if not is_exact(sales, "net_sales_amount"):
        raise ValueError("the state needs decimal amounts, see run_silver(money=...)")
    whole = months is None
    if whole:
        months = partitions_of(sales, kpi.MONTH)
        if fmt == "parquet":
            months = sorted({*months, *_stored_months(spark, paths)}, key=str)
    chosen = sales.where(in_partitions(kpi.MONTH, months))
    # Of a full refresh all shipments count; those without an order fall out of the left join.
    shipped = logistics if whole else logistics.join(chosen.select("order_id").distinct(), "order_id", "left_semi")
    used = chosen.select(*GRAIN, *kpi.MONTH, "order_id", "customer_id", "net_sales_amount", "sales_amount", "discount", "quantity")
    orders = preaggregate_then_left_join(used, shipped, "order_id", kpi.order_shipping(exact=True))
    numbers = add_numbers(chosen, "customer_id", _path(paths, "customer_numbers"))
    replace_partitions(month_sums(orders), _path(paths, "sums"), kpi.MONTH, months)
    replace_partitions(month_customers(chosen, numbers), _path(paths, "customers"), kpi.MONTH, months)
    return list(months)


def _stored_months(spark: SparkSession, paths: LayerPaths) -> list[Partition]:
    from pyspark.errors import AnalysisException

    try:
        return partitions_of(read_table(spark, _path(paths, "sums"), merge_schema=False), kpi.MONTH)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []


def _merged(spark: SparkSession, paths: LayerPaths, grain: Sequence[str]) -> DataFrame:
    """The state's sums and exact distinct customers at a coarser ``grain``."""
    sums = read_table(spark, _path(paths, "sums"), merge_schema=False)
    bits = read_table(spark, _path(paths, "customers"), merge_schema=False)
    each = bits.groupBy(*grain, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
    merged = each.groupBy(*grain).agg(F.sum("n").alias("customers"))
    whole = sums.groupBy(*grain).agg(*(F.sum(name).alias(name) for name in SUMS))
    other = merged.select(*(F.col(c).alias(f"__{c}") for c in grain), "customers")
    same = F.lit(True)
    for c in grain:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return whole.join(other, same, "left").drop(*(f"__{c}" for c in grain)).withColumn("customers", F.coalesce("customers", F.lit(0)))


def _mean(name: str, scale: int = 2) -> Column:
    return ratio(F.col(name), F.col(f"{name}_n"), scale, exact=True)


def _money(name: str) -> Column:
    return F.round(F.col(name), 2)


def _volume() -> list[Column]:
    return [
        F.col("units").alias("total_units_sold"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
    ]


def sales_by_region(spark: SparkSession, paths: LayerPaths, as_of: datetime | None = None) -> DataFrame:
    """As ``kpi.sales_by_region``, from the state."""
    state = _merged(spark, paths, kpi.MONTH_GRAIN)
    months = state.select(
        *kpi.MONTH_GRAIN,
        _money("net").alias("total_net_revenue"),
        _money("gross").alias("total_gross_revenue"),
        _mean("gross").alias("avg_order_value"),
        _mean("discount").alias("avg_discount_pct"),
        *_volume(),
        ratio(F.col("net"), F.col("customers"), 2, exact=True).alias("revenue_per_customer"),
    )
    ranked = rank_within(months, "total_net_revenue", kpi.MONTH, "region_rank_by_revenue")
    return stamp_layer(growth_pct(ranked, "total_net_revenue", ["region"], kpi.MONTH, "mom_growth_pct"), "gold", as_of)


def sales_by_category(spark: SparkSession, paths: LayerPaths, as_of: datetime | None = None) -> DataFrame:
    """As ``kpi.sales_by_category``, from the state: three months' bitmaps are OR-ed."""
    state = _merged(spark, paths, kpi.QUARTER_GRAIN)
    quarters = state.select(
        *kpi.QUARTER_GRAIN,
        _money("net").alias("total_net_revenue"),
        _mean("net").alias("avg_net_revenue_per_order"),
        _mean("discount").alias("avg_discount_pct"),
        *_volume(),
    )
    return stamp_layer(share_of_total(quarters, "total_net_revenue", kpi.QUARTER, "revenue_share_pct"), "gold", as_of)


def executive_summary(spark: SparkSession, paths: LayerPaths, as_of: datetime | None = None) -> DataFrame:
    """As ``kpi.executive_summary``, from the state."""
    state = _merged(spark, paths, kpi.MONTH_GRAIN)
    months = state.select(
        *kpi.MONTH_GRAIN,
        _money("net").alias("total_net_revenue"),
        *_volume(),
        _mean("discount").alias("avg_discount_pct"),
        _mean("lead", 1).alias("avg_delivery_lead_time"),
        _money("freight").alias("total_freight_cost"),
        ratio(F.col("on_time"), F.col("orders"), 2, times=100, exact=True).alias("on_time_delivery_rate_pct"),
        ratio(F.col("freight"), F.col("net"), 2, times=100, exact=True).alias("freight_cost_as_pct_revenue"),
    )
    return stamp_layer(months, "gold", as_of)


#: The gold tables that the state holds.
TABLES = {
    "sales_by_region": sales_by_region,
    "sales_by_category": sales_by_category,
    "executive_summary": executive_summary,
}
