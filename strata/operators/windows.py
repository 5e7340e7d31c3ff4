"""Ranking, growth and share over partitions of a table.

The default forms use one window per partition. They fit the aggregated tables
the KPIs are built on, where a partition has one row per region or category.
``spread`` gives the same numbers on tables whose partitions may be very large:
no partition is then gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.metrics import is_exact, ratio
from strata.operators.joins import attach
from strata.scratch import scratch_dir


def rank_within(
    df: DataFrame,
    by: str,
    partition: Sequence[str],
    name: str,
    *,
    descending: bool = True,
    spread: int | None = None,
) -> DataFrame:
    """Rank of ``by`` inside each partition, with gaps after ties.

    ``spread`` is a number of tasks. Equal values are first counted with
    map-side combine, so a mass of ties is one row. The counts are sorted over
    ``spread`` range partitions, ranked inside each of them, and shifted by the
    size of the better ones; a hot partition then spans many tasks. The sorted
    counts are stored in the scratch folder, because both the ranks and the
    shifts need the same cut into ranges. The rank is then a long, as it may
    exceed an int.
    """

    def best_first(column: str) -> Column:
        column = F.col(column)
        return column.desc_nulls_last() if descending else column.asc_nulls_first()

    if spread is None:
        window = Window.partitionBy(*partition).orderBy(best_first(by))
        return df.withColumn(name, F.rank().over(window))

    spark = df.sparkSession
    tallies = df.groupBy(*partition, by).agg(F.count(F.lit(1)).alias("__n"))
    placed = tallies.repartitionByRange(spread, *partition, best_first(by))
    chunked = placed.withColumn("__chunk", F.spark_partition_id())
    stored = scratch_dir(spark, "rank")
    chunked.write.parquet(stored)
    tallies = spark.read.schema(chunked.schema).parquet(stored)

    def ahead(size: str, within: Sequence[str], order: Column) -> Column:
        window = Window.partitionBy(*within).orderBy(order)
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(before), F.lit(0).cast("long"))

    chunk = [*partition, "__chunk"]
    sizes = tallies.groupBy(*chunk).agg(F.sum("__n").alias("__size"))
    shifts = sizes.select(*chunk, ahead("__size", partition, F.col("__chunk")).alias("__shift"))
    inside = tallies.select(*chunk, by, ahead("__n", chunk, best_first(by)).alias("__inside"))
    place = F.col("__shift") + F.col("__inside") + F.lit(1)
    ranks = attach(inside, shifts, chunk).select(*partition, by, place.alias(name))
    return attach(df, ranks, [*partition, by])


def growth_pct(
    df: DataFrame,
    value: str,
    entity: Sequence[str],
    time: Sequence[str],
    name: str,
    *,
    scale: int = 2,
    calendar: bool = False,
) -> DataFrame:
    """Growth in percent over the entity's previous row in ``time`` order.

    ``df`` has one row per entity and period, so a partition is bounded by the
    number of periods. The previous row is the last period that exists, and a
    null period sorts first. With ``calendar`` (``time`` = year, month) a gap
    or a null period gives null instead. No growth over a zero or null value.
    """
    window = Window.partitionBy(*entity).orderBy(*[F.col(t).asc_nulls_first() for t in time])
    before = F.lag(value).over(window)
    if calendar:
        year, month = (F.col(t) for t in time)
        index = year * F.lit(12) + month
        before = F.when(index - F.lag(index).over(window) == 1, before)
    exact = is_exact(df, value)
    step = df.withColumn("__before", before)
    change = ratio(F.col(value) - F.col("__before"), F.col("__before"), scale, 100, exact)
    return step.withColumn(name, change).drop("__before")


def share_of_total(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    name: str,
    *,
    scale: int = 2,
    spread: bool = False,
) -> DataFrame:
    """Value as a percentage of its partition's sum; null when the sum is zero.

    ``spread`` sums the partitions with map-side aggregation and joins the sums
    back, instead of buffering each partition in a window. It reads ``df`` twice.
    """
    exact = is_exact(df, value)
    if spread:
        sums = df.groupBy(*partition).agg(F.sum(value).alias("__sum"))
        step = attach(df, sums, partition)
    else:
        step = df.withColumn("__sum", F.sum(value).over(Window.partitionBy(*partition)))
    share = ratio(F.col(value), F.col("__sum"), scale, 100, exact)
    return step.withColumn(name, share).drop("__sum")
