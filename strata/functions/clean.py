"""Row-level business expressions. Column in, Column out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults of the business rules; every function takes its own.
SLA_MAX_DAYS = 7
IN_TRANSIT = "EM_TRANSITO"
SLA_BANDS = ((80, "ABAIXO_SLA"), (95, "ATENCAO"))
SLA_BAND_ELSE = "OK"


def normalize(text: Column) -> Column:
    """Upper case without surrounding spaces (spaces only; tabs stay)."""
    return F.upper(F.trim(text))


def net_amount(amount: Column, pct: Column, scale: int = 2, exact: bool = False) -> Column:
    """Amount after a percentage discount, rounded half up.

    ``exact`` is for decimal inputs: it multiplies first and divides once, so
    the only rounding is the final one.
    """
    if exact:
        return F.round(amount * (F.lit(100) - pct) / F.lit(100), scale)
    return F.round(amount * (F.lit(1) - pct / F.lit(100)), scale)


def quarter_label(date: Column) -> Column:
    """``Q1`` .. ``Q4``; null for a null date."""
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def lead_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; negative when they are swapped."""
    return F.datediff(end, start)


def sla_flag(days: Column, max_days: int = SLA_MAX_DAYS) -> Column:
    """True when delivered within ``max_days``.

    Unknown lead time counts as late, so rates built on this flag hold rows
    still in transit against the carrier; negative lead times count as on time.
    """
    return F.coalesce(days <= max_days, F.lit(False))


def override_when_null(value: Column, watched: Column, label: str = IN_TRANSIT) -> Column:
    """``label`` where ``watched`` is null, else ``value``."""
    return F.when(watched.isNull(), F.lit(label)).otherwise(value)


def band(
    value: Column,
    steps: Iterable[tuple[float, str]] = SLA_BANDS,
    otherwise: str = SLA_BAND_ELSE,
) -> Column:
    """Label of the lowest step whose limit lies above ``value``.

    Values above every limit, and nulls, get ``otherwise``.
    """
    label = F.lit(otherwise)
    for limit, name in sorted(steps, reverse=True):
        label = F.when(value < F.lit(limit), F.lit(name)).otherwise(label)
    return label
