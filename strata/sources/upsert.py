"""Newest-wins upserts into a partitioned table with one row for each key.

The result is the one of a full rebuild, ``dedup_latest`` over everything that ever
arrived, but only the partitions that a change touches are read in full and written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest
from strata.scratch import scratch_dir, scratch_scope
from strata.sources.partitions import Partition, in_partitions, partitions_of, replace_partitions
from strata.sources.readers import read_table


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    matches = [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns]
    out = matches[0]
    for match in matches[1:]:
        out = out & match
    return out


def locate(table: DataFrame, changes: DataFrame, keys: Sequence[str], others: Sequence[str]) -> DataFrame:
    """Keys of ``changes`` that the table holds, with their ``others``: scans these columns only."""
    wanted = [*keys, *(c for c in others if c not in keys)]
    held = table.select(*(f"`{c}`" for c in wanted)).alias("t")
    return held.join(changes.select(*(f"`{k}`" for k in keys)).distinct().alias("c"), _same("t", "c", keys), "left_semi")


def upsert_latest(
    spark: SparkSession,
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    newest: str,
    partition_cols: Sequence[str],
    *,
    tie_breakers: Sequence[Column | str] | None = None,
    text_partitions: Sequence[str] = (),
) -> list[Partition]:
    """Merge ``changes`` into the table at ``path``; returns the partitions that were rewritten.

    Of several changes of a key the newest counts. A late one, older than the stored row,
    touches nothing. A row whose partition value changes leaves its old partition, which
    disappears with its last row. Ties are broken as in a rebuild: by ``tie_breakers``,
    which default to all other columns in the table's order (partition columns last).
    Null keys are one key.

    Reads keys, ``newest`` and partition columns of the whole table (the lookup), and all
    columns of the touched partitions. What reaches the driver are partition values.
    """
    table = read_table(spark, path, merge_schema=False, text_partitions=text_partitions)
    columns = [f"`{c}`" for c in table.columns]
    with scratch_scope(spark):
        stored = scratch_dir(spark, "changes")
        # Partition columns last, as in the table; types as stored.
        typed = changes.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.schema))
        dedup_latest(typed, keys, newest, tie_breakers).write.parquet(stored)
        latest = spark.read.schema(typed.schema).parquet(stored)

        places = scratch_dir(spark, "places")
        locate(table, latest, keys, [newest, *partition_cols]).write.parquet(places)
        placed = spark.read.schema(typed.select(*{*keys, newest, *partition_cols}).schema).parquet(places)
        now, then = F.col(f"c.`{newest}`"), F.col(f"t.`{newest}`")
        older = then.isNotNull() & (now.isNull() | (now < then))
        winning = latest.alias("c").join(placed.alias("t"), _same("t", "c", keys) & older, "left_anti")

        left = placed.alias("t").join(winning.select(*(f"`{k}`" for k in keys)).alias("c"), _same("t", "c", keys), "left_semi")
        touched = sorted({*partitions_of(left, partition_cols), *partitions_of(winning, partition_cols)}, key=str)
        if touched:
            kept = table.where(in_partitions(partition_cols, touched)).select(*columns)
            merged = dedup_latest(kept.unionByName(winning.select(*columns)), keys, newest, tie_breakers)
            replace_partitions(merged, path, partition_cols, touched)
    return touched
