"""Deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position"


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest: str | None = None,
    tie_breakers: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Keep one row per key: the newest, then the first by ``tie_breakers``.

    Without ``newest`` any row may stay; the tie-breakers still make the choice
    repeatable. They default to all other columns, ascending, nulls first. Null
    keys form one group.

    The filter on ``row_number() = 1`` lets Catalyst put a group limit in front
    of the shuffle, so each map task sends one row per key. A key that holds a
    large part of the table therefore never meets in one task as a whole.
    """
    if tie_breakers is None:
        used = {*keys, newest}
        tie_breakers = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in used]
    order = [] if newest is None else [F.col(f"`{newest}`").desc_nulls_last()]
    order += list(tie_breakers)
    if not order:
        return df.dropDuplicates(list(keys))
    position = F.row_number().over(Window.partitionBy(*(f"`{k}`" for k in keys)).orderBy(*order))
    return df.withColumn(_POSITION, position).filter(F.col(_POSITION) == 1).drop(_POSITION)


def dedup_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows``, ``distinct_keys`` and ``removed`` by a dedup on ``keys``.

    Counts per key are combined before the shuffle; null keys are one key.
    """
    per_key = df.groupBy(*(f"`{k}`" for k in keys)).agg(F.count(F.lit(1)).alias("__copies"))
    rows = F.coalesce(F.sum("__copies"), F.lit(0).cast("long"))
    return per_key.agg(rows.alias("rows"), F.count(F.lit(1)).alias("distinct_keys")).select(
        "rows", "distinct_keys", (F.col("rows") - F.col("distinct_keys")).alias("removed")
    )
