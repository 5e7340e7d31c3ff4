from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.plans import (
    executive_summary,
    logistics_kpi,
    sales_by_category,
    sales_by_region,
    shipping_by_order,
)
from tests.conftest import plan_of, values
from verification.queries import clean_logistics, clean_sales

SALES = (
    "order_id string, customer_id string, region string, product_category string, "
    "sales_amount {m}, net_sales_amount {m}, discount double, quantity int, "
    "order_year int, order_month int, order_quarter string"
)
SHIPMENTS = (
    "shipment_id string, order_id string, carrier string, status string, dispatch_date date, "
    "delivery_lead_time_days int, delivered_on_time boolean, freight_cost double"
)
TABLES = "/root/testdata/sf0.001"


def sale(order, customer="C1", region="N", net=90.0, month=1, category="F", quantity=1):
    when = (2024, month, f"Q{(month + 2) // 3}") if month else (None, None, None)
    gross = None if net is None else net + 10
    return (order, customer, region, category, gross, net, 10.0, quantity, *when)


@pytest.fixture
def sales(rows):
    return lambda *data: rows(SALES.format(m="double"), *data)


def picked(df, *columns):
    return values(df.select(*columns))


def test_region_months_have_rank_and_growth(sales):
    df = sales(
        sale("1", "C1"), sale("2", "C1", net=10.0), sale("3", "C2", "S", 100.0),
        sale("4", "C3", "S", 250.0, month=3), sale("5", None, "X", 40.0),
    )
    got = picked(
        sales_by_region(df), "region", "order_month", "total_net_revenue", "total_orders",
        "unique_customers", "revenue_per_customer", "region_rank_by_revenue", "mom_growth_pct",
    )
    assert got == [
        ("N", 1, 100.0, 2, 1, 100.0, 1, None),
        ("S", 1, 100.0, 1, 1, 100.0, 1, None),
        ("S", 3, 250.0, 1, 1, 250.0, 1, 150.0),
        ("X", 1, 40.0, 1, 0, None, 3, None),
    ]


def test_rows_without_a_date_come_before_the_first_month(sales):
    df = sales(sale("1", net=50.0, month=None), sale("2", net=100.0, month=1))
    assert picked(sales_by_region(df), "order_month", "mom_growth_pct") == [(None, None), (1, 100.0)]


def test_category_share_uses_the_quarter(sales):
    df = sales(
        sale("1", category="F", net=1.0), sale("2", category="G", net=2.0, month=2),
        sale("3", category="F", net=5.0, month=4), sale("4", category="Z", net=0.0, month=7),
    )
    got = picked(sales_by_category(df), "product_category", "order_quarter", "revenue_share_pct")
    assert got == [("F", "Q1", 33.33), ("F", "Q2", 100.0), ("G", "Q1", 66.67), ("Z", "Q3", None)]


def test_share_and_growth_use_rounded_totals(sales):
    df = sales(sale("1", category="F", net=0.126), sale("2", category="G", net=0.374))
    shares = picked(sales_by_category(df), "product_category", "revenue_share_pct")
    assert shares == [("F", 26.0), ("G", 74.0)]
    df = sales(sale("1", net=0.126), sale("2", net=0.374, month=2))
    assert picked(sales_by_region(df), "mom_growth_pct") == [(None,), (184.62,)]


def test_carrier_rates_count_transit_as_late(rows):
    day = date(2024, 1, 1)
    df = rows(
        SHIPMENTS,
        *[(f"S{i}", "1", "A", "ENTREGUE", day, 2, True, 1.5) for i in range(9)],
        ("S9", "1", "A", "ENTREGUE", day, -1, True, None),
        ("T0", "1", "A", "EM_TRANSITO", day, None, False, 2.0),
        *[(f"U{i}", "2", "B", "ENTREGUE", day, 5 + i, i < 4, 1.0) for i in range(5)],
    )
    assert values(logistics_kpi(df).drop("_gold_timestamp")) == [
        ("A", "EM_TRANSITO", 1, None, None, None, 0.0, 2.0, 2.0, "ABAIXO_SLA"),
        ("A", "ENTREGUE", 10, 1.7, -1, 2, 100.0, 13.5, 1.5, "OK"),
        ("B", "ENTREGUE", 5, 7.0, 5, 9, 80.0, 5.0, 1.0, "ATENCAO"),
    ]


SHIPPED = (
    ("S1", "1", "A", "X", date(2024, 1, 2), 1, True, 1.0),
    ("S2", "1", "B", "Y", date(2024, 1, 1), 2, False, 2.0),
    ("S3", "2", "A", "X", date(2024, 1, 1), 2, False, 4.0),
    ("S4", "9", "A", "X", date(2024, 1, 1), 2, True, 8.0),
)


def test_executive_summary_keeps_orders_without_shipments(sales, rows):
    """Two-step rounding of lead times; the on-time base is all orders."""
    df = sales(sale("1", "C1", quantity=2), sale("2", "C2"), sale("3", "C2", net=20.0))
    got = executive_summary(df, rows(SHIPMENTS, *SHIPPED)).drop("_gold_timestamp").first().asDict()
    assert got == {
        "region": "N", "order_year": 2024, "order_month": 1, "order_quarter": "Q1",
        "total_net_revenue": 200.0, "total_orders": 3, "unique_customers": 2,
        "total_units_sold": 4, "avg_discount_pct": 10.0, "avg_delivery_lead_time": 1.8,
        "total_freight_cost": 7.0, "on_time_delivery_rate_pct": 33.33,
        "freight_cost_as_pct_revenue": 3.5,
    }


def test_executive_summary_of_zero_revenue(sales, rows):
    row = executive_summary(sales(sale("1", net=0.0)), rows(SHIPMENTS, *SHIPPED)).first()
    assert row.freight_cost_as_pct_revenue is None


def test_first_shipment_is_the_earliest(rows):
    got = shipping_by_order(rows(SHIPMENTS, *SHIPPED), with_first=True)
    assert picked(got, "order_id", "primary_carrier", "shipment_status") == [
        ("1", "B", "Y"), ("2", "A", "X"), ("9", "A", "X"),
    ]


@pytest.fixture(scope="module")
def clean(spark):
    return clean_sales(spark, TABLES).cache(), clean_logistics(spark, TABLES).cache()


def test_declared_order_grain_changes_the_plan_not_the_result(clean):
    sales, logistics = clean
    pairs = [
        (lambda **k: sales_by_region(sales, **k)),
        (lambda **k: sales_by_category(sales, **k)),
        (lambda **k: executive_summary(sales, logistics, **k)),
    ]
    for build in pairs:
        general = build().drop("_gold_timestamp")
        grain = build(one_row_per_order=True).drop("_gold_timestamp")
        assert values(general) == values(grain)
        assert "Expand" in plan_of(general) and "Expand" not in plan_of(grain)


def test_spread_rank_gives_the_same_table(clean):
    sales, _ = clean
    plain = sales_by_region(sales).drop("_gold_timestamp")
    spread = sales_by_region(sales, rank_spread=8).drop("_gold_timestamp")
    assert values(plain) == values(spread.select(*plain.columns))


def test_spread_share_gives_the_same_table(clean):
    sales, _ = clean
    plain = sales_by_category(sales).drop("_gold_timestamp")
    spread = sales_by_category(sales, share_spread=True).drop("_gold_timestamp")
    assert values(plain) == values(spread.select(*plain.columns))


def test_double_money_stays_within_a_cent_of_decimal_money(clean):
    sales, _ = clean
    money = ("sales_amount", "net_sales_amount", "discount")
    double = sales.withColumns({c: F.col(c).cast("double") for c in money})
    key = ["region", "order_year", "order_month"]
    exact = {tuple(r[k] for k in key): r for r in sales_by_region(sales).collect()}
    for row in sales_by_region(double).collect():
        other = exact[tuple(row[k] for k in key)]
        for column in ("total_net_revenue", "avg_order_value", "revenue_per_customer"):
            if row[column] is not None:
                assert abs(row[column] - float(other[column])) < 0.0101


def test_executive_plan_has_one_join_and_no_unused_columns(clean, spark, folder):
    for name, df in zip(("sales", "logistics"), clean, strict=True):
        df.write.parquet(f"{folder}/{name}")
    stored = [spark.read.parquet(f"{folder}/{name}") for name in ("sales", "logistics")]
    plan = plan_of(executive_summary(*stored, one_row_per_order=True))
    assert plan.count("Join") == 1 and "Expand" not in plan
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert len(schemas) == 2
    assert not any(c in schema for schema in schemas for c in ("carrier", "salesperson", "_city"))


def test_ranks_start_at_one(clean):
    firsts = sales_by_region(clean[0]).groupBy("order_year", "order_month").agg(
        F.min("region_rank_by_revenue").alias("first")
    )
    assert {r["first"] for r in firsts.collect()} == {1}
