from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.plans import refine_logistics, refine_sales, rejected_logistics, rejected_sales

SALES = (
    "order_id string, order_date string, customer_id string, product_id string, "
    "product_category string, region string, sales_amount string, quantity string, "
    "discount string, salesperson_id string, _ingestion_timestamp timestamp, _layer string"
)
SHIPMENTS = (
    "shipment_id string, order_id string, dispatch_date string, delivery_date string, "
    "carrier string, origin_city string, destination_city string, freight_cost string, "
    "status string, _layer string"
)
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def sale(order="O1", day="2024-05-01", amount="$1,250.00", at=T1, region=" norte ", **over):
    row = {
        "customer": " cli-1", "product": "P1", "category": "food", "quantity": "3",
        "discount": "10%", "person": "ven-1",
    } | over
    return (
        order, day, row["customer"], row["product"], row["category"], region, amount,
        row["quantity"], row["discount"], row["person"], at, "bronze",
    )


@pytest.fixture
def sales(rows):
    return lambda *data: rows(SALES, *data)


def test_clean_sale(sales):
    row = refine_sales(sales(sale()), as_of=T2).first().asDict()
    assert row == {
        "order_id": "O1", "order_date": date(2024, 5, 1), "customer_id": "CLI-1",
        "product_id": "P1", "product_category": "FOOD", "region": "NORTE", "sales_amount": 1250.0,
        "quantity": 3, "discount": 10.0, "salesperson_id": "VEN-1", "_ingestion_timestamp": T1,
        "_layer": "silver", "net_sales_amount": 1125.0, "order_year": 2024, "order_month": 5,
        "order_quarter": "Q2", "_silver_timestamp": T2,
    }


def test_an_order_whose_newest_copy_lacks_an_amount_vanishes(sales):
    df = sales(sale(at=T1), sale(amount=None, at=T2), sale("O2"))
    assert [r.order_id for r in refine_sales(df).collect()] == ["O2"]


def test_unreadable_values_survive_as_null(sales):
    row = refine_sales(sales(sale(day="soon", amount="n/a"))).first()
    assert (row.sales_amount, row.net_sales_amount, row.order_date) == (None, None, None)
    assert (row.order_year, row.order_month, row.order_quarter) == (None, None, None)


def test_null_keys_are_dropped(sales):
    assert refine_sales(sales(sale(None), sale(None, at=T2))).count() == 0


def test_defaults_and_blank_region(sales):
    df = sales(sale(region=None, category=None, discount=None), sale("O2", region="  "))
    got = {r.order_id: (r.region, r.product_category, r.discount) for r in refine_sales(df).collect()}
    assert got == {
        "O1": ("REGIAO_DESCONHECIDA", "NAO_CLASSIFICADO", 0.0), "O2": ("", "FOOD", 10.0),
    }
    filled = refine_sales(df, blank_as_null=True).filter("order_id = 'O2'").first()
    assert filled.region == "REGIAO_DESCONHECIDA"


def test_decimal_money(sales):
    df = refine_sales(sales(sale(amount="$200.10", discount="15%")), money="decimal(18,2)")
    types = dict(df.dtypes)
    assert types["sales_amount"] == types["net_sales_amount"] == "decimal(18,2)"
    assert str(df.first().net_sales_amount) == "170.09"


def test_rejected_sales_are_the_dropped_and_the_blanked(sales):
    df = sales(
        sale("ok"), sale("no-amount", amount=None), sale("bad-amount", amount="n/a"),
        sale("bad-date", day="soon"), sale(None),
    )
    got = {r.order_id: r._reject_reasons for r in rejected_sales(df).collect()}
    assert got == {
        "no-amount": ["missing:sales_amount"], "bad-amount": ["unreadable:sales_amount"],
        "bad-date": ["unreadable:order_date"], None: ["missing:order_id"],
    }
    kept = {r.order_id for r in refine_sales(df).collect()}
    assert kept == {"ok", "bad-amount", "bad-date"}


def shipment(key="S1", sent="2024-01-01", got="05/01/2024", status=" entregue ", freight="$12.50"):
    return (key, "O1", sent, got, " acme ", "são paulo", "recife", freight, status, "bronze")


def test_clean_shipment(rows):
    row = refine_logistics(rows(SHIPMENTS, shipment()), as_of=T2).first().asDict()
    assert row == {
        "shipment_id": "S1", "order_id": "O1", "dispatch_date": date(2024, 1, 1),
        "delivery_date": date(2024, 1, 5), "carrier": "ACME", "origin_city": "SÃO PAULO",
        "destination_city": "RECIFE", "freight_cost": 12.5, "status": "ENTREGUE",
        "_layer": "silver", "delivery_lead_time_days": 4, "delivered_on_time": True,
        "_silver_timestamp": T2,
    }


def test_undelivered_shipments_are_in_transit_and_late(rows):
    df = rows(SHIPMENTS, shipment("S1", got=None), shipment("S2", got="later"), shipment("S3", sent=None))
    got = {r.shipment_id: (r.status, r.delivered_on_time) for r in refine_logistics(df).collect()}
    assert got == {"S1": ("EM_TRANSITO", False), "S2": ("EM_TRANSITO", False)}


def test_sla_limit_is_a_parameter(rows):
    df = rows(SHIPMENTS, shipment())
    assert refine_logistics(df, max_days=3).first().delivered_on_time is False


def test_rejected_logistics(rows):
    df = rows(SHIPMENTS, shipment("ok", got=None), shipment("x", sent=None), shipment("y", freight="?"))
    got = {r.shipment_id: r._reject_reasons for r in rejected_logistics(df).collect()}
    assert got == {"x": ["missing:dispatch_date"], "y": ["unreadable:freight_cost"]}


def test_duplicate_shipments_do_not_depend_on_partitioning(rows):
    data = [shipment("S1", freight=f"${i}.00") for i in range(9)]
    df = rows(SHIPMENTS, *data)
    costs = {
        refine_logistics(df.repartition(n, F.col("freight_cost"))).first().freight_cost
        for n in (1, 3, 7)
    }
    assert costs == {0.0}


def test_a_later_ingestion_of_a_shipment_wins(rows):
    first = rows(SHIPMENTS, shipment()).withColumns(
        {"delivery_date": F.lit(None).cast("string"), "_ingestion_timestamp": F.lit("2024-01-01").cast("timestamp")}
    )
    second = rows(SHIPMENTS, shipment()).withColumn("_ingestion_timestamp", F.lit("2024-01-02").cast("timestamp"))
    for both in (first.unionByName(second), second.unionByName(first)):
        assert refine_logistics(both).first().delivery_date is not None
