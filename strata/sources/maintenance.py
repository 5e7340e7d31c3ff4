"""Table maintenance as Spark jobs: compaction, Z-order, orphan listing.

Compaction and clustering write a new folder; a table is never rewritten in
place. Rows are addressed by file and row number, which are the same on every
run of a task, so a hot partition value, a hot cluster cell or a mass of
identical rows is split evenly and survives a lost executor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.audit import moment
from strata.operators.ranges import order_codes, range_edges, range_id
from strata.scratch import scratch_scope
from strata.sources.readers import read_table

TARGET_FILE_BYTES = 256 * 1024 * 1024
RETENTION_HOURS = 168  # fixed value: seven days
_ADDRESS = ("__file", "__row")
SAMPLE_SETTING = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
SAMPLED_ROWS = 20_000


def data_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Files under ``root``: ``path, modified, bytes``. File contents are not read."""
    scan = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return scan.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def planned_files(
    spark: SparkSession, root: str, target_bytes: int = TARGET_FILE_BYTES, glob: str = "*.parquet"
) -> int:
    """Number of ``target_bytes`` files that hold the table. Runs one small aggregate."""
    size = data_files(spark, root, glob).agg(F.sum("bytes")).first()[0] or 0
    return max(1, -(-size // target_bytes))


def _addressed(df: DataFrame) -> DataFrame:
    address = (F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index"))
    return df.select("*", *[c.alias(name) for c, name in zip(address, _ADDRESS, strict=True)])


def stored_partitions(spark: SparkSession, root: str, glob: str = "*.parquet") -> list[str]:
    """Names of the partition columns in the table's folders, outermost first."""
    first = data_files(spark, root, glob).select("path").first()
    inside = first["path"].split(root.rstrip("/").rpartition("/")[2] + "/", 1)[-1] if first else ""
    return [folder.partition("=")[0] for folder in inside.split("/")[:-1] if "=" in folder]


def _kept(
    spark: SparkSession, src: str, partition_cols: Sequence[str] | None, text_partitions: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """The table and its new partition columns; values of those it keeps stay as stored."""
    stored = stored_partitions(spark, src)
    cols = stored if partition_cols is None else list(partition_cols)
    text = [c for c in stored if c in cols or c in text_partitions]
    return read_table(spark, src, text_partitions=text), cols


def _write(df: DataFrame, dst: str, partition_cols: Sequence[str]) -> None:
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(dst)


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    *,
    target_files: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    partition_cols: Sequence[str] | None = None,
    text_partitions: Sequence[str] = (),
) -> None:
    """Rewrite a Parquet table into few even files, keeping every row.

    The table's own partitioning stays, its values as stored (``007`` is not 7),
    unless ``partition_cols`` says otherwise; ``()`` drops it.
    Without partition columns the scan's splits are merged without a shuffle.
    With them rows are range-partitioned by partition value and row address:
    neighbours share a task, a large value spans several, and the stored row
    order inside a value is kept.
    """
    files = target_files or planned_files(spark, src, target_bytes)
    df, cols = _kept(spark, src, partition_cols, text_partitions)
    if cols:
        placed = _addressed(df).repartitionByRange(files, *cols, *_ADDRESS)
        df = placed.sortWithinPartitions(*cols, *_ADDRESS).drop(*_ADDRESS)
    else:
        df = df.coalesce(files)
    _write(df, dst, cols)


@contextmanager
def _sampled(spark: SparkSession, files: int) -> Iterator[None]:
    """Fewer sampled rows a range, the more ranges: their sample reaches the driver.

    Up to ``SAMPLED_ROWS`` in all and 10 a range at least. Samples choose where ranges end,
    never which rows are written.
    """
    before = spark.conf.get(SAMPLE_SETTING)
    spark.conf.set(SAMPLE_SETTING, str(max(10, min(int(before), SAMPLED_ROWS // files))))
    try:
        yield
    finally:
        spark.conf.set(SAMPLE_SETTING, before)


def interleave(ids: Sequence[Column], bits: int) -> Column:
    """Z-value: bit ``b`` of id ``i`` becomes bit ``b * len(ids) + i``."""
    if bits * len(ids) > 62:
        raise ValueError("bits * columns must not exceed 62")
    taken = [
        F.shiftleft(F.shiftright(i.cast("long"), b).bitwiseAND(F.lit(1)), b * len(ids) + at)
        for b in range(bits)
        for at, i in enumerate(ids)
    ]
    return reduce(lambda low, high: low.bitwiseOR(high), taken)


def with_z_value(
    df: DataFrame, columns: Sequence[str], name: str = "__z", bits: int = 5
) -> DataFrame:
    """Add the Z-value of ``columns`` over ``2 ** bits`` quantile ranges each.

    Nulls share the lowest range. Runs one quantile aggregate over the columns
    (and one min/max when a text column is among them).
    """
    codes = order_codes(df, columns)
    edges = range_edges(df, codes, 2**bits)
    ids = {c: f"__range{i}" for i, c in enumerate(columns)}
    ranged = df.withColumns(
        {ids[c]: F.coalesce(range_id(codes[c], edges[c]), F.lit(0)) for c in columns}
    )
    z = interleave([F.col(i) for i in ids.values()], bits)
    return ranged.withColumn(name, z).drop(*ids.values())


def zorder(
    spark: SparkSession,
    src: str,
    dst: str,
    columns: Sequence[str],
    *,
    target_files: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    bits: int = 5,
    partition_cols: Sequence[str] | None = None,
    text_partitions: Sequence[str] = (),
) -> None:
    """Rewrite a Parquet table clustered by ``columns``, keeping every row.

    Partitioning is kept as in ``compact``. ``bits`` times the number of columns is
    62 at most.
    Rows that are close in all columns share files, so min/max statistics skip
    files and row groups for filters on any of them. The row address behind the
    Z-value splits a cell that is larger than a file.
    """
    files = target_files or planned_files(spark, src, target_bytes)
    df, cols = _kept(spark, src, partition_cols, text_partitions)
    with scratch_scope(spark):
        keyed = with_z_value(_addressed(df), columns, "__z", bits)
        with _sampled(spark, files):
            placed = keyed.repartitionByRange(files, *cols, "__z", *_ADDRESS)
            ordered = placed.sortWithinPartitions(*cols, "__z")
            _write(ordered.drop("__z", *_ADDRESS), dst, cols)


def orphan_files(
    spark: SparkSession,
    root: str,
    live: DataFrame,
    retention_hours: float = RETENTION_HOURS,
    *,
    as_of: datetime | None = None,
    glob: str = "*.parquet",
) -> DataFrame:
    """Files under ``root`` that ``live`` does not read and that are old enough.

    ``live`` lists the files in use in a column ``path`` (a manifest, or
    ``data_files`` of the version in use): two listings are anti-joined and no
    table is read. Given the table as currently read instead, its files are
    those that the plan's scans have listed. Nothing is deleted.
    """
    if "path" in live.columns:
        used = live.select("path").distinct()
    else:
        used = spark.createDataFrame([(path,) for path in live.inputFiles()], "path string").distinct()
    age = F.unix_micros(moment(as_of)) - F.unix_micros("modified")
    old = age > F.lit(int(retention_hours * 3_600_000_000))

    def name(path: str) -> Column:  # local files are written with one slash or three
        return F.regexp_replace(path, "^file:/+", "file:/")

    names = used.select(name("path").alias("__name"))
    return data_files(spark, root, glob).filter(old).join(names, name("path") == F.col("__name"), "left_anti")
