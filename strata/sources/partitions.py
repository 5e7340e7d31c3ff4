"""Replacing some partitions of a partitioned Parquet table, and only these."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.scratch import remove, scratch_dir, scratch_scope
from strata.sources.writers import spread_by

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a null partition value

Partition = tuple[object, ...]


def partition_key(columns: Sequence[str]) -> Column:
    """One text for each combination of partition values; nulls are a value."""
    return F.concat_ws("/", *(F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("null")) for c in columns))


def partitions_of(df: DataFrame, columns: Sequence[str]) -> list[Partition]:
    """Distinct partition values; as many as the folders that hold them."""
    return [tuple(row) for row in df.select(*(f"`{c}`" for c in columns)).distinct().collect()]


def in_partitions(columns: Sequence[str], partitions: Sequence[Partition]) -> Column:
    """Whether a row is in one of ``partitions``: a filter on partition columns, so others are not listed in the scan."""
    keys = ["/".join("null" if v is None else f"={_text(v)}" for v in values) for values in partitions]
    return partition_key(columns).isin(keys) if keys else F.lit(False)


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _folder(spark: SparkSession, path: str, columns: Sequence[str], values: Partition) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = (f"{escape(c)}={NULL_FOLDER if v is None or v == '' else escape(_text(v))}" for c, v in zip(columns, values, strict=True))
    return "/".join([path.rstrip("/"), *parts])


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str], partitions: Sequence[Partition]) -> None:
    """Let ``partitions`` of the table at ``path`` hold the rows of ``df``, and keep all other files.

    ``df`` may read the table: its rows are stored in a scratch folder first, so that a task
    that is run again never reads a partition that has been replaced. Partitions without a
    row are removed. A partition is replaced as a whole when the job commits; several are
    replaced one after the other.
    """
    spark = df.sparkSession
    with scratch_scope(spark):
        staged = scratch_dir(spark, "partitions")
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        held = set(partitions_of(rows, columns))
        strange = held.difference(partitions)
        if strange:
            raise ValueError(f"rows outside the given partitions, for instance {sorted(map(str, strange))[0]}")
        if held:
            writer = spread_by(rows, columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*columns).parquet(path)
        for values in set(partitions).difference(held):
            remove(spark, _folder(spark, path, columns, values))
