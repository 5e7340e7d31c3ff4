"""Which files of a table can hold rows of a range: statistics of each file, kept as a table.

Min/max statistics inside Parquet files are seen only after a file has been opened. The
statistics table answers before: a filter on it, one row for each file, names the files to
scan. On a Z-ordered table ranges of any clustered column leave out most of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.manifest import paths_of
from strata.sources.readers import read_table

Range = tuple[object, object]


def write_file_stats(
    spark: SparkSession, path: str, columns: Sequence[str], stats: str, *, values: int = 32, text_partitions: Sequence[str] = ()
) -> None:
    """Write statistics of ``columns`` for each file of the table at ``path``.

    A row holds the file, its rows, and for each column the smallest and largest value, the
    nulls, and all values if there are about ``values`` of them or fewer (else null). One
    pass over these columns, combined in the tasks, and one for the sets of such files.
    """
    table = read_table(spark, path, merge_schema=False, text_partitions=text_partitions)
    file = F.col("_metadata.file_path").alias("file")
    # Sets are collected only where a sketch says that they are small.
    rows = table.select(file, *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    sizes = rows.groupBy("file").agg(
        F.count("*").alias("rows"),
        *(F.min(f"c{i}").alias(f"min_{i}") for i in range(len(columns))),
        *(F.max(f"c{i}").alias(f"max_{i}") for i in range(len(columns))),
        *(F.count_if(F.col(f"c{i}").isNull()).alias(f"nulls_{i}") for i in range(len(columns))),
        *(F.approx_count_distinct(f"c{i}").alias(f"n_{i}") for i in range(len(columns))),
    )
    out = sizes
    for i in range(len(columns)):
        few = sizes.where(F.col(f"n_{i}") <= values).select("file")
        distinct = rows.join(few, "file", "left_semi").select("file", f"c{i}").where(F.col(f"c{i}").isNotNull()).distinct()
        sets = distinct.groupBy("file").agg(F.sort_array(F.collect_list(f"c{i}")).alias(f"set_{i}"))
        out = out.join(sets, "file", "left")
    named = [F.struct(F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max"), F.col(f"nulls_{i}").alias("nulls"), F.col(f"set_{i}").alias("values")).alias(c) for i, c in enumerate(columns)]
    path_text = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    out.select(path_text.alias("path"), "rows", *named).write.mode("overwrite").parquet(stats)


def may_hold(ranges: Mapping[str, Range]) -> Column:
    """Whether a file can hold a row inside all ``ranges`` (both ends included; None is open)."""
    keep = F.lit(True)
    for column, (low, high) in ranges.items():
        least, most, values = (F.col(f"`{column}`.{part}") for part in ("min", "max", "values"))
        if low is not None:
            keep = keep & (most >= F.lit(low))
        if high is not None:
            keep = keep & (least <= F.lit(high))
        keep = keep & least.isNotNull() & _known_inside(values, low, high)
    return F.coalesce(keep, F.lit(False))


def _known_inside(values: Column, low: object, high: object) -> Column:
    """True unless all values are known and none of them is in the range."""
    return values.isNull() | F.exists(values, lambda v: _inside(v, low, high))


def _inside(value: Column, low: object, high: object) -> Column:
    inside = value.isNotNull()
    if low is not None:
        inside = inside & (value >= F.lit(low))
    if high is not None:
        inside = inside & (value <= F.lit(high))
    return inside


def kept_files(spark: SparkSession, stats: str, ranges: Mapping[str, Range]) -> DataFrame:
    """``path, rows`` of the files that can hold such rows."""
    return spark.read.parquet(stats).where(may_hold(ranges)).select("path", "rows")


def read_ranges(spark: SparkSession, path: str, stats: str, ranges: Mapping[str, Range], text_partitions: Sequence[str] = ()) -> DataFrame:
    """Rows of the table inside all ``ranges``; only files that can hold some are opened."""
    table = read_table(spark, path, merge_schema=False, text_partitions=text_partitions)
    files = paths_of(kept_files(spark, stats, ranges))
    if not files:
        return table.limit(0)
    keep = F.lit(True)
    for column, (low, high) in ranges.items():
        keep = keep & _inside(F.col(f"`{column}`"), low, high)
    return spark.read.schema(table.schema).option("basePath", path).parquet(*files).where(keep)
