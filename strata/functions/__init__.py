"""Column expressions: parsing, row-level cleaning and aggregate metrics."""

from strata.functions.clean import (
    band,
    lead_days,
    net_amount,
    normalize,
    override_when_null,
    quarter_label,
    sla_flag,
)
from strata.functions.metrics import (
    any_true,
    distinct,
    distinct_sketch,
    first_by,
    is_exact,
    mean,
    merged_distinct,
    rate_pct,
    ratio,
    total,
)
from strata.functions.parse import parse_date, parse_int, parse_money, parse_percent

__all__ = [
    "any_true",
    "band",
    "distinct",
    "distinct_sketch",
    "first_by",
    "is_exact",
    "lead_days",
    "mean",
    "merged_distinct",
    "net_amount",
    "normalize",
    "override_when_null",
    "parse_date",
    "parse_int",
    "parse_money",
    "parse_percent",
    "quarter_label",
    "rate_pct",
    "ratio",
    "sla_flag",
    "total",
]
