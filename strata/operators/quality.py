"""Quality gate, column profile and rejected rows. Each is one pass, no action."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: largest share of nulls, in percent, that raises no warning.
MAX_NULL_PCT = 5.0


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row holding the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def gate_metrics(*critical: str) -> list[Column]:
    """Counts the gate needs, for ``agg`` or for an ``Observation``: rows, and rows with a null among ``critical``."""
    missing = reduce(or_, [F.col(f"`{c}`").isNull() for c in critical])
    return [F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("null_critical")]


def null_pct(nulls: Column, total: Column) -> Column:
    """Percentage of nulls; 0 for an empty table."""
    return F.coalesce(F.try_divide(nulls, total) * F.lit(100), F.lit(0.0))


def null_gate(df: DataFrame, key: str, max_pct: float = MAX_NULL_PCT) -> DataFrame:
    """One row: ``total``, ``null_critical``, ``null_pct``, ``passed``.

    The gate reports and does not block; callers decide what ``passed`` means.
    """
    counts = df.agg(*gate_metrics(key))
    pct = null_pct(F.col("null_critical"), F.col("total"))
    return counts.withColumn("null_pct", pct).withColumn("passed", F.col("null_pct") <= max_pct)


def profile(df: DataFrame, flag_above: float = MAX_NULL_PCT) -> DataFrame:
    """One row per column: ``column, total, nulls, null_pct, flagged``.

    All columns are counted in a single global aggregate whose one result row
    is then unfolded.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
            for i, c in enumerate(df.columns)
        ],
    )
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
            for i, c in enumerate(df.columns)
        ]
    )
    long = counts.select("total", F.inline(lines)).select("column", "total", "nulls")
    pct = null_pct(F.col("nulls"), F.col("total"))
    return long.withColumn("null_pct", pct).withColumn("flagged", F.col("null_pct") > flag_above)


def rejected(
    df: DataFrame, required: Sequence[str], readable: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows a cleaning step drops or blanks, with the reasons in ``_reject_reasons``.

    ``required`` columns must be present. ``readable`` maps a raw column to its
    parsed form; a present value whose parsed form is null is unreadable.
    """
    checks = {f"missing:{c}": F.col(c).isNull() for c in required}
    for column, parsed in (readable or {}).items():
        checks[f"unreadable:{column}"] = F.col(column).isNotNull() & parsed.isNull()
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(why)) for why, bad in checks.items()]))
    return df.filter(reduce(or_, checks.values())).withColumn("_reject_reasons", reasons)
