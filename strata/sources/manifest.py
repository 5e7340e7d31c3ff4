"""Lists of ingested files: what a run has to read is known before it reads anything.

A manifest is a small Parquet table, one row for each file that a run has ingested. The
next run lists its inputs, leaves out what the manifest holds, and scans the rest by path,
so its cost follows what is new and not the history. A file that is written anew under an
old name is another version (its time and size differ) and counts as new.

The rows are appended before the manifest. A run that dies between the two ingests its
files again; the newest-per-key rule of the trusted layer absorbs that.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.audit import moment
from strata.sources.readers import read_table

SCHEMA = "path string, modified timestamp, bytes long, ingested timestamp"
VERSION = ["path", "modified", "bytes"]


def list_files(spark: SparkSession, inputs: str | Sequence[str]) -> DataFrame:
    """``path, modified, bytes`` of all files under ``inputs`` (folders, files or globs); no content is read."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = scan.load(inputs if isinstance(inputs, str) else list(inputs))
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The stored list; empty before the first run."""
    from pyspark.sql.types import _parse_datatype_string

    try:
        return read_table(spark, manifest, schema=_parse_datatype_string(SCHEMA))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def new_files(spark: SparkSession, inputs: str | Sequence[str], manifest: str) -> DataFrame:
    """Listed files whose present version the manifest does not hold: an anti-join of two listings."""
    return list_files(spark, inputs).join(read_manifest(spark, manifest).select(*VERSION), VERSION, "left_anti")


def store_new_files(spark: SparkSession, inputs: str | Sequence[str], manifest: str, path: str) -> DataFrame:
    """``new_files`` as one file at ``path``; returns the stored list.

    A shuffle, and not ``coalesce``, brings the few rows together: the listing has a task
    for every 128 MB of input, and one task would hold the joined manifest once for each.
    """
    new_files(spark, inputs, manifest).repartition(1).write.parquet(path)
    return spark.read.parquet(path)


def literal_path(path: str) -> str:
    """The path as a glob that matches it alone."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def paths_of(files: DataFrame) -> list[str]:
    """Paths of one run's files, for a reader; a scan holds its file list on the driver in any case."""
    return sorted(literal_path(row["path"]) for row in files.select("path").collect())


def record_files(files: DataFrame, manifest: str, as_of: datetime | None = None) -> None:
    """Append ``files`` to the manifest."""
    rows = files.select(*VERSION, moment(as_of).alias("ingested"))
    rows.coalesce(1).write.mode("append").parquet(manifest)
