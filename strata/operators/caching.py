"""Scoped caching of an input that several outputs read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(
    df: DataFrame,
    level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    *,
    materialize: bool = False,
) -> Iterator[DataFrame]:
    """Persist ``df`` for the block and release it afterwards.

    Blocks lost with an executor are recomputed from the lineage. A ``level``
    of None keeps the input uncached, for tables that storage serves better
    (column-pruned rescans) than memory does. ``materialize`` fills the cache
    up front with a count.
    """
    if level is None:
        yield df
        return
    held = df.persist(level)
    try:
        if materialize:
            held.count()
        yield held
    finally:
        held.unpersist()
