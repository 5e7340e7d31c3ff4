"""Raw to trusted: the sales and logistics cleaning plans.

The order of steps is part of the result. Deduplication comes first, so an
order whose newest copy lacks an amount disappears as a whole; the null filter
looks at the raw text, so present but unreadable values survive as null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import clean, parse
from strata.operators.audit import stamp_layer
from strata.operators.dedup import dedup_latest
from strata.operators.quality import rejected
from strata.operators.shaping import calendar_parts, fill_defaults, normalize_text

EXACT_MONEY = "decimal(18,2)"
EXACT_PERCENT = "decimal(9,4)"

# Keys, required columns, text columns and null defaults.
INGESTED = "_ingestion_timestamp"
SALES_KEY = "order_id"
SALES_REQUIRED = ("order_id", "sales_amount", "order_date")
SALES_CRITICAL = ("order_id", "sales_amount", "order_date")
SALES_TEXT = ("region", "product_category", "customer_id", "salesperson_id")
SALES_DEFAULTS = {
    "discount": 0.0,
    "product_category": "NAO_CLASSIFICADO",
    "region": "REGIAO_DESCONHECIDA",
}
LOGISTICS_KEY = "shipment_id"
LOGISTICS_REQUIRED = ("shipment_id", "dispatch_date")
LOGISTICS_CRITICAL = ("shipment_id", "dispatch_date", "freight_cost")
LOGISTICS_TEXT = ("carrier", "status", "origin_city", "destination_city")


def _sales_types(money: str) -> dict[str, Column]:
    percent = "double" if money == "double" else EXACT_PERCENT
    return {
        "sales_amount": parse.parse_money(F.col("sales_amount"), money),
        "quantity": parse.parse_int(F.col("quantity")),
        "discount": parse.parse_percent(F.col("discount"), percent),
        "order_date": parse.parse_date(F.col("order_date"), parse.ORDER_DATE_FORMATS),
    }


def _logistics_types(money: str) -> dict[str, Column]:
    def day(name: str) -> Column:
        return parse.parse_date(F.col(name), parse.SHIPMENT_DATE_FORMATS)

    return {
        "dispatch_date": day("dispatch_date"),
        "delivery_date": day("delivery_date"),
        "freight_cost": parse.parse_money(F.col("freight_cost"), money),
    }


def latest_sales(raw: DataFrame, tie_breakers: Sequence[Column | str] | None = None) -> DataFrame:
    """Newest copy per order."""
    return dedup_latest(raw, [SALES_KEY], "_ingestion_timestamp", tie_breakers)


def latest_logistics(
    raw: DataFrame, newest: str | None = INGESTED, tie_breakers: Sequence[Column | str] | None = None
) -> DataFrame:
    """Newest copy per shipment, so that a later ingestion's update wins.

    Among copies of one ingestion, and in raw input without ingestion times, the
    tie-breakers choose, the same way on every run.
    """
    if newest == INGESTED and newest not in raw.columns:
        newest = None
    return dedup_latest(raw, [LOGISTICS_KEY], newest, tie_breakers)


@dataclass(frozen=True)
class Refined:
    """A cleaning plan in its two halves: the newest copies, and what is made of them."""

    latest: DataFrame
    dropped: Column  # which of them lack a required value
    clean: Callable[[DataFrame], DataFrame]

    def finish(self, latest: DataFrame) -> DataFrame:
        """The trusted table from (observed) newest copies."""
        return self.clean(latest.where(~self.dropped))

    @property
    def table(self) -> DataFrame:
        return self.finish(self.latest)


def _missing(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def plan_sales(
    raw: DataFrame,
    *,
    money: str = "double",
    tie_breakers: Sequence[Column | str] | None = None,
    blank_as_null: bool = False,
    as_of: datetime | None = None,
) -> Refined:
    """Trusted sales, one row per order.

    ``money`` is the type of amounts: ``double``, or a decimal such as
    ``decimal(18,2)`` whose sums do not depend on the order of addition.
    """

    def clean_rows(kept: DataFrame) -> DataFrame:
        typed = normalize_text(kept.withColumns(_sales_types(money)), SALES_TEXT)
        filled = fill_defaults(typed, SALES_DEFAULTS, blank_as_null=blank_as_null)
        net = clean.net_amount(F.col("sales_amount"), F.col("discount"), exact=money.startswith("decimal"))
        if money != "double":
            net = net.cast(money)
        derived = calendar_parts(filled.withColumn("net_sales_amount", net), "order_date", "order")
        return stamp_layer(derived, "silver", as_of)

    return Refined(latest_sales(raw, tie_breakers), _missing(SALES_REQUIRED), clean_rows)


def plan_logistics(
    raw: DataFrame,
    *,
    money: str = "double",
    newest: str | None = INGESTED,
    tie_breakers: Sequence[Column | str] | None = None,
    max_days: int = clean.SLA_MAX_DAYS,
    as_of: datetime | None = None,
) -> Refined:
    """Trusted logistics, one row per shipment."""

    def clean_rows(kept: DataFrame) -> DataFrame:
        typed = normalize_text(kept.withColumns(_logistics_types(money)), LOGISTICS_TEXT)
        dispatched, delivered = F.col("dispatch_date"), F.col("delivery_date")
        days = clean.lead_days(dispatched, delivered)
        derived = typed.withColumns(
            {
                "delivery_lead_time_days": days,
                "delivered_on_time": clean.sla_flag(days, max_days),
                "status": clean.override_when_null(F.col("status"), delivered),
            }
        )
        return stamp_layer(derived, "silver", as_of)

    return Refined(latest_logistics(raw, newest, tie_breakers), _missing(LOGISTICS_REQUIRED), clean_rows)


def refine_sales(raw: DataFrame, **options: object) -> DataFrame:
    """The trusted table of ``plan_sales``, which has the options."""
    return plan_sales(raw, **options).table


def refine_logistics(raw: DataFrame, **options: object) -> DataFrame:
    """The trusted table of ``plan_logistics``, which has the options."""
    return plan_logistics(raw, **options).table


def rejected_sales(
    raw: DataFrame, tie_breakers: Sequence[Column | str] | None = None, *, money: str = "double"
) -> DataFrame:
    """Newest copies that ``refine_sales`` drops, or keeps with a blanked amount or date.

    ``money`` is the type the refined table gives amounts; what that cannot hold is listed.
    """
    readable = _sales_types(money)
    return rejected(
        latest_sales(raw, tie_breakers),
        SALES_REQUIRED,
        {c: readable[c] for c in ("sales_amount", "order_date")},
    )


def rejected_logistics(
    raw: DataFrame,
    newest: str | None = INGESTED,
    tie_breakers: Sequence[Column | str] | None = None,
    *,
    money: str = "double",
) -> DataFrame:
    """Copies that ``refine_logistics`` drops, or keeps with a blanked date or cost."""
    return rejected(
        latest_logistics(raw, newest, tie_breakers),
        LOGISTICS_REQUIRED,
        _logistics_types(money),
    )
