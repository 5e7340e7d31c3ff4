"""Joins of facts with pre-aggregated or small sides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.heavy import broadcast_if_small


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


#: Largest side, in bytes of its rows, that ``broadcast=True`` broadcasts.
BROADCAST_BYTES = 10 * 1024 * 1024


def enrich_left(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    *,
    broadcast: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left outer join with USING semantics: every fact stays, key columns once.

    The strategy is left to Spark: a side under the session's broadcast
    threshold is broadcast, decided on its measured size under adaptive
    execution; larger sides shuffle and hot keys are split by the skew-join
    rule (see ``join_heavy`` for keys known to be heavy). ``broadcast`` asks for
    more: the side's rows are measured first, by a job of its own, and broadcast
    if they take ``broadcast_bytes`` at most; otherwise Spark decides as before.
    """
    side = broadcast_if_small(dim, broadcast_bytes) if broadcast else dim
    return facts.join(side, on=_keys(on), how="left")


def preaggregate(rows: DataFrame, on: str | Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Bring ``rows`` to one row per key, with map-side partial aggregation."""
    return rows.groupBy(*_keys(on)).agg(*aggs)


def preaggregate_then_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    aggs: Sequence[Column],
    *,
    broadcast: bool = False,
) -> DataFrame:
    """Left join against one aggregated row per key, so ``left`` never fans out."""
    return enrich_left(left, preaggregate(right, on, aggs), on, broadcast=broadcast)


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys match null keys.

    ``right`` must hold one row per key. It may derive from ``left``: its keys
    are renamed first, so the self-join stays unambiguous.
    """
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"__{k}") for k in keys],
        *[f"`{c}`" for c in right.columns if c not in keys],
    )
    match = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in keys])
    return left.join(renamed, match, "left").drop(*[f"__{k}" for k in keys])
