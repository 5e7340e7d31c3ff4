"""The four KPI tables.

Money may be double or decimal in the trusted tables; the formulas follow the
type (see ``strata.functions.metrics``). ``one_row_per_order`` states what the
cleaning plan guarantees: no ``order_id`` repeats. Order counts are then plain
counts, which leaves ``customer_id`` as the only distinct count, so the plan
needs no row expansion and never shuffles order ids for counting.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import any_true, band, distinct, first_by, is_exact, mean, rate_pct, ratio, total
from strata.operators.audit import stamp_layer
from strata.operators.joins import attach, preaggregate, preaggregate_then_left_join
from strata.operators.windows import growth_pct, rank_within, share_of_total

MONTH = ("order_year", "order_month")
MONTH_GRAIN = ("region", *MONTH, "order_quarter")
QUARTER = ("order_year", "order_quarter")
QUARTER_GRAIN = ("product_category", *QUARTER)
CARRIER_GRAIN = ("carrier", "status")


def _net_revenue() -> Column:
    return total(F.col("net_sales_amount")).alias("total_net_revenue")


def _volume(one_row_per_order: bool) -> list[Column]:
    return [
        F.sum("quantity").alias("total_units_sold"),
        distinct("order_id", one_row_per_order).alias("total_orders"),
        distinct("customer_id").alias("unique_customers"),
    ]


def _mean_discount(exact: bool) -> Column:
    return mean(F.col("discount"), 2, exact).alias("avg_discount_pct")


def sales_by_region(
    sales: DataFrame,
    *,
    one_row_per_order: bool = False,
    rank_spread: int | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Revenue, volume, rank and growth per region and month.

    Set ``rank_spread`` where regions are free text and a month may hold very
    many of them.
    """
    exact = is_exact(sales, "net_sales_amount")
    amount = F.col("sales_amount")
    per_customer = ratio(
        F.sum("net_sales_amount"), distinct("customer_id"), 2, exact=exact
    )
    months = sales.groupBy(*MONTH_GRAIN).agg(
        _net_revenue(),
        total(amount).alias("total_gross_revenue"),
        mean(amount, 2, exact).alias("avg_order_value"),
        _mean_discount(exact),
        *_volume(one_row_per_order),
        per_customer.alias("revenue_per_customer"),
    )
    ranked = rank_within(
        months, "total_net_revenue", MONTH, "region_rank_by_revenue", spread=rank_spread
    )
    if rank_spread is not None:
        place = F.col("region_rank_by_revenue").cast("int")
        ranked = ranked.withColumn("region_rank_by_revenue", place)
    grown = growth_pct(ranked, "total_net_revenue", ["region"], MONTH, "mom_growth_pct")
    return stamp_layer(grown, "gold", as_of)


def sales_by_category(
    sales: DataFrame,
    *,
    one_row_per_order: bool = False,
    share_spread: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """Revenue, volume and revenue share per product category and quarter.

    The share is taken of the rounded totals. Set ``share_spread`` where
    categories are free text and a quarter may hold very many of them.
    """
    exact = is_exact(sales, "net_sales_amount")
    quarters = sales.groupBy(*QUARTER_GRAIN).agg(
        _net_revenue(),
        mean(F.col("net_sales_amount"), 2, exact).alias("avg_net_revenue_per_order"),
        _mean_discount(exact),
        *_volume(one_row_per_order),
    )
    shared = share_of_total(
        quarters, "total_net_revenue", QUARTER, "revenue_share_pct", spread=share_spread
    )
    return stamp_layer(shared, "gold", as_of)


def logistics_kpi(logistics: DataFrame, *, as_of: datetime | None = None) -> DataFrame:
    """Lead times, on-time rate, freight and SLA band per carrier and status.

    Shipments still in transit count against the on-time rate.
    """
    exact = is_exact(logistics, "freight_cost")
    days, freight = F.col("delivery_lead_time_days"), F.col("freight_cost")
    carriers = logistics.groupBy(*CARRIER_GRAIN).agg(
        F.count("shipment_id").alias("total_shipments"),
        mean(days, 1).alias("avg_lead_time_days"),
        F.min(days).alias("min_lead_time_days"),
        F.max(days).alias("max_lead_time_days"),
        rate_pct(F.col("delivered_on_time"), F.count("shipment_id"), exact=exact).alias(
            "on_time_delivery_rate_pct"
        ),
        total(freight).alias("total_freight_cost"),
        mean(freight, 2, exact).alias("avg_freight_cost_per_shipment"),
    )
    flagged = carriers.withColumn(
        "carrier_performance_flag", band(F.col("on_time_delivery_rate_pct"))
    )
    return stamp_layer(flagged, "gold", as_of)


def order_shipping(exact: bool) -> list[Column]:
    """Aggregates that bring shipments to order grain."""
    lead = mean(F.col("delivery_lead_time_days"), 1)
    return [
        (lead.cast("decimal(10,1)") if exact else lead).alias("avg_lead_time"),
        total(F.col("freight_cost")).alias("total_freight_cost"),
        any_true(F.col("delivered_on_time")).alias("delivered_on_time"),
    ]


def shipping_by_order(logistics: DataFrame, *, with_first: bool = False) -> DataFrame:
    """Shipments at order grain.

    ``with_first`` adds carrier and status of the order's first shipment, by
    dispatch date and then shipment id.
    """
    aggs = order_shipping(is_exact(logistics, "freight_cost"))
    if with_first:
        order = [F.col("dispatch_date"), F.col("shipment_id")]
        aggs += [
            first_by(F.col("carrier"), order).alias("primary_carrier"),
            first_by(F.col("status"), order).alias("shipment_status"),
        ]
    return preaggregate(logistics, "order_id", aggs)


def executive_summary(
    sales: DataFrame,
    logistics: DataFrame,
    *,
    one_row_per_order: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """Sales and delivery figures per region and month.

    Orders without shipments stay and count in the on-time denominator. The
    mean lead time is the mean of the orders' rounded means.
    """
    exact = is_exact(sales, "net_sales_amount")
    orders = preaggregate_then_left_join(
        sales, logistics, "order_id", order_shipping(exact)
    )
    months = orders.groupBy(*MONTH_GRAIN).agg(
        _net_revenue(),
        *_volume(one_row_per_order),
        _mean_discount(exact),
        *_delivery(exact),
    )
    return stamp_layer(months, "gold", as_of)


def _delivery(exact: bool) -> list[Column]:
    """Delivery figures of orders that carry their ``order_shipping``."""
    freight, net = F.sum("total_freight_cost"), F.sum("net_sales_amount")
    return [
        mean(F.col("avg_lead_time"), 1, exact).alias("avg_delivery_lead_time"),
        total(F.col("total_freight_cost")).alias("total_freight_cost"),
        rate_pct(F.col("delivered_on_time"), F.count("order_id"), exact=exact).alias(
            "on_time_delivery_rate_pct"
        ),
        ratio(freight, net, 2, times=100, exact=exact).alias("freight_cost_as_pct_revenue"),
    ]


def delivery_by_region(sales: DataFrame, logistics: DataFrame) -> DataFrame:
    """The delivery figures of ``executive_summary`` per region and month.

    Without distinct customers, so orders are summed where they are joined.
    """
    exact = is_exact(sales, "net_sales_amount")
    orders = preaggregate_then_left_join(
        sales.select(*MONTH_GRAIN, "order_id", "net_sales_amount"), logistics, "order_id", order_shipping(exact)
    )
    return orders.groupBy(*MONTH_GRAIN).agg(*_delivery(exact))


def executive_on_regions(
    regions: DataFrame, delivery: DataFrame, *, as_of: datetime | None = None
) -> DataFrame:
    """``executive_summary`` from ``sales_by_region`` and ``delivery_by_region`` of the same sales."""
    figures = [
        "total_net_revenue", "total_units_sold", "total_orders", "unique_customers", "avg_discount_pct",
    ]
    months = attach(regions.select(*MONTH_GRAIN, *figures), delivery, MONTH_GRAIN)
    return stamp_layer(months, "gold", as_of)
