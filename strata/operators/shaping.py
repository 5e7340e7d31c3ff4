"""Projections and filters over whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import clean


def require_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows in which every one of ``columns`` is present."""
    return df.filter(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns]))


def normalize_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim and upper-case ``columns`` in one projection."""
    return df.withColumns({c: clean.normalize(F.col(f"`{c}`")) for c in columns})


def fill_defaults(
    df: DataFrame, defaults: Mapping[str, object], *, blank_as_null: bool = False
) -> DataFrame:
    """Replace nulls per column.

    Only null is replaced by default: text that trims to nothing stays as it is
    unless ``blank_as_null`` is set.
    """
    if blank_as_null:
        text = [c for c in defaults if isinstance(df.schema[c].dataType, T.StringType)]
        df = df.withColumns(
            {c: F.when(F.trim(F.col(c)) != "", F.col(c)) for c in text}
        )
    return df.fillna(dict(defaults))


def calendar_parts(df: DataFrame, date: str, prefix: str = "order") -> DataFrame:
    """Add ``<prefix>_year``, ``<prefix>_month`` and ``<prefix>_quarter``."""
    day = F.col(date)
    return df.withColumns(
        {
            f"{prefix}_year": F.year(day),
            f"{prefix}_month": F.month(day),
            f"{prefix}_quarter": clean.quarter_label(day),
        }
    )


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows in ``order``: a top-n per task, then one merge of those."""
    return df.orderBy(*order).limit(n)
