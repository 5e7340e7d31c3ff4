"""Audit columns with an injectable clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(as_of: datetime | None) -> Column:
    """``as_of`` as a timestamp, or the start time of the query when None."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def source_file(df: DataFrame) -> Column:
    """File each row was read from.

    Uses the scan's metadata column where ``df`` still exposes it; otherwise
    ``input_file_name``, which is empty after a shuffle.
    """
    try:
        df.select("_metadata.file_path").schema
    except AnalysisException:
        return F.input_file_name()
    return F.col("_metadata.file_path")


def with_audit(df: DataFrame, layer: str = "bronze", as_of: datetime | None = None) -> DataFrame:
    """Add ingestion time, source file and layer name."""
    return df.withColumns(
        {
            "_ingestion_timestamp": moment(as_of),
            "_source_file": source_file(df),
            "_layer": F.lit(layer),
        }
    )


def stamp_layer(df: DataFrame, layer: str, as_of: datetime | None = None) -> DataFrame:
    """Add ``_<layer>_timestamp`` and overwrite ``_layer`` where it exists."""
    columns = {f"_{layer}_timestamp": moment(as_of)}
    if "_layer" in df.columns:
        columns["_layer"] = F.lit(layer)
    return df.withColumns(columns)


def with_ingestion_year(
    df: DataFrame, as_of: datetime | None = None, name: str = "_year"
) -> DataFrame:
    """Add the partition column for the year of ingestion."""
    return df.withColumn(name, F.year(moment(as_of)))
