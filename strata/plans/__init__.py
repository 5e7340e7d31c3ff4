"""Composed plans: cleaning, KPI tables and layer runs."""

from strata.plans.kpi import (
    executive_summary,
    logistics_kpi,
    sales_by_category,
    sales_by_region,
    shipping_by_order,
)
from strata.plans.layers import run_bronze, run_gold, run_silver
from strata.plans.refine import (
    refine_logistics,
    refine_sales,
    rejected_logistics,
    rejected_sales,
)

__all__ = [
    "executive_summary",
    "logistics_kpi",
    "refine_logistics",
    "refine_sales",
    "rejected_logistics",
    "rejected_sales",
    "run_bronze",
    "run_gold",
    "run_silver",
    "sales_by_category",
    "sales_by_region",
    "shipping_by_order",
]
