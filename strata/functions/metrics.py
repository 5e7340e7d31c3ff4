"""Aggregate expressions for ``groupBy(...).agg(...)``.

All of them have partial (map-side) forms, so a hot group reaches the shuffle
as one row per map task. ``exact`` is for decimals and counts: the result is
the true quotient, rounded once. Without it the double formulas keep their
usual order of operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_exact(df: DataFrame, column: str) -> bool:
    """Whether ``column`` is a decimal, so that metrics on it can be exact."""
    return isinstance(df.schema[column].dataType, T.DecimalType)


def total(value: Column, scale: int = 2) -> Column:
    """Rounded sum."""
    return F.round(F.sum(value), scale)


def mean(value: Column, scale: int, exact: bool = False) -> Column:
    """Rounded average of the non-null values."""
    if exact:
        return ratio(F.sum(value), F.count(value), scale, exact=True)
    return F.round(F.avg(value), scale)


def ratio(
    top: Column, bottom: Column, scale: int = 2, times: int = 1, exact: bool = False
) -> Column:
    """``top / bottom * times``, rounded half up; null where ``bottom`` is zero.

    The exact form counts how often ``bottom`` fits. Decimal division would
    round once to the digits left beside the operands' widths (six for large
    sums) and again to ``scale``.
    """
    if not exact:
        quotient = F.try_divide(top, bottom)
        return F.round(quotient * F.lit(times) if times != 1 else quotient, scale)
    unit = 10**scale
    doubled = F.abs(bottom) * F.lit(2)
    halves = F.abs(top) * F.lit(2 * times * unit) + F.abs(bottom)
    fits = F.try_divide(halves - F.try_mod(halves, doubled), doubled).cast("decimal(38,0)")
    signed = F.when((top < 0) != (bottom < 0), -fits).otherwise(fits)
    return F.round(signed / F.lit(unit), scale)


def rate_pct(flag: Column, base: Column, scale: int = 2, exact: bool = False) -> Column:
    """Share of ``base`` (a count) whose ``flag`` is true, in percent."""
    return ratio(F.sum(flag.cast("int")), base, scale, times=100, exact=exact)


def any_true(flag: Column) -> Column:
    """True when one non-null flag is true."""
    return F.bool_or(flag)


def first_by(value: Column, order: Sequence[Column]) -> Column:
    """Value of the row that comes first in ``order`` (nulls included)."""
    return F.min_by(F.struct(value.alias("v")), F.struct(*order)).getField("v")


def distinct(column: str, unique: bool = False) -> Column:
    """Exact distinct count of ``column``.

    ``unique`` states that no value repeats in the input. A plain count then
    gives the same number and keeps every value of the column out of the shuffle.
    """
    return F.count(column) if unique else F.countDistinct(column)


#: log2 of a sketch's cells: standard error 0.8 % above some hundred values, exact in effect below.
SKETCH_BITS = 14


def distinct_sketch(column: str, bits: int = SKETCH_BITS) -> Column:
    """Sketch of the distinct values of ``column``, to be stored beside exact counts.

    Its size is bounded (``2 ** bits`` cells, fewer for small groups), whatever the group.
    """
    return F.hll_sketch_agg(column, bits)


def merged_distinct(sketch: str) -> Column:
    """Estimated distinct values of all groups whose sketches meet, in any order."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))
