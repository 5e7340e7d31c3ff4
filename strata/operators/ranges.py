"""Order-preserving value ranges: a long code per value and a small range id.

The driver receives only the range edges (at most ``ranges`` numbers per
column), never data. Given the edges, a row's range depends on its value alone,
so a recomputed task puts every row where it was before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.scratch import scratch_dir

def order_codes(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Value per column that sorts like the column; null stays null. Text is its own code."""
    types = {c: df.schema[c].dataType for c in columns}
    codes = {}
    for c in columns:
        value, kind = F.col(c), types[c]
        if isinstance(kind, T.DateType):
            codes[c] = F.unix_date(value)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            codes[c] = F.unix_micros(value.cast("timestamp"))
        elif isinstance(kind, T.BooleanType):
            codes[c] = value.cast("int")
        else:
            codes[c] = value
    return codes


#: Distinct texts whose counts the driver may hold.
FEW_TEXTS = 10_000


def text_edges(df: DataFrame, text: Column, ranges: int, few: int = FEW_TEXTS) -> list[str]:
    """Values at which the running share of rows, in text order, crosses ``i / ranges``.

    Whole texts are counted. Up to ``FEW_TEXTS`` of them the driver finds the edges;
    beyond, counts are sorted over many tasks, in a scratch table, and summed by task,
    and only the edges reach the driver. Both give the same edges. Runs jobs.
    """
    spark = df.sparkSession
    counts = df.select(text.alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    first = counts.limit(few + 1).collect()
    if len(first) <= few:
        edges, seen, total = [], 0, sum(n for _, n in first)
        for value, n in sorted(first, key=lambda row: row[0].encode()):
            if seen and seen * ranges // total < (seen + n) * ranges // total:
                edges.append(value)
            seen += n
        return edges
    path = scratch_dir(spark, "texts")
    counts.repartitionByRange("v").select("v", "n", F.spark_partition_id().alias("p")).write.parquet(path)
    sorted_ = spark.read.schema("v string, n long, p int").parquet(path)
    totals = sorted_.groupBy("p").agg(F.sum("n").alias("own"))
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select("p", (F.sum("own").over(upto) - F.col("own")).alias("before"))
    total = totals.agg(F.sum("own")).first()[0] or 0
    inside = Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("before") + F.sum("n").over(inside)
    steps = sorted_.join(offsets, "p").select("v", (last - F.col("n")).alias("low"), last.alias("high"))
    crossed = F.floor(F.col("low") * ranges / total) < F.floor(F.col("high") * ranges / total)
    edges = steps.where(crossed & (F.col("low") > 0)).select("v")
    return sorted((row[0] for row in edges.collect()), key=str.encode) if total else []


def range_edges(
    df: DataFrame, codes: Mapping[str, Column], ranges: int
) -> dict[str, list[object]]:
    """Up to ``ranges`` distinct quantile edges per code; one aggregate, and jobs per text column."""
    points = [i / ranges for i in range(1, ranges)]
    text = {c for c in codes if isinstance(df.select(codes[c]).schema[0].dataType, T.StringType)}
    numbers = [c for c in codes if c not in text]
    quantiles = [F.percentile_approx(codes[c], points, 20 * ranges).alias(f"q{i}") for i, c in enumerate(numbers)]
    found = df.agg(*quantiles).first() if quantiles else ()
    edges = {c: sorted(set(found[i] or [])) for i, c in enumerate(numbers)}
    return {c: text_edges(df, codes[c], ranges)[: ranges - 1] if c in text else edges[c] for c in codes}


def range_id(code: Column, edges: Sequence[object]) -> Column:
    """Number of edges at or below ``code``, by binary search; null for null."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(code < F.lit(edges[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return F.when(code.isNotNull(), search(0, len(edges)))
