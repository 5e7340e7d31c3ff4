"""File and table scans under explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.contracts import CORRUPT_COLUMN, conform


def _with_corrupt(contract: T.StructType, column: str | None) -> T.StructType:
    if column is None:
        return contract
    return T.StructType([*contract.fields, T.StructField(column, T.StringType(), True)])


def read_csv_contract(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: T.StructType,
    *,
    enforce_header: bool = False,
    corrupt_column: str | None = CORRUPT_COLUMN,
) -> DataFrame:
    """Header-line UTF-8 CSV under ``contract``; lines are splittable.

    Columns are taken by position. ``enforce_header`` makes the read fail when
    the header's names differ from the contract. Lines with too few or too many
    fields are padded or cut, and their text is kept in ``corrupt_column``
    (complete only when all contract columns are read).
    """
    reader = (
        spark.read.schema(_with_corrupt(contract, corrupt_column))
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("multiLine", False)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not enforce_header)
    )
    if corrupt_column is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_json_contract(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: T.StructType,
    *,
    multi_line: bool = True,
    corrupt_column: str | None = CORRUPT_COLUMN,
) -> DataFrame:
    """JSON under ``contract``; unreadable text lands in ``corrupt_column``.

    ``multi_line`` reads one document (an object or an array of objects) per
    file, so a file is one task: large inputs should come as many files, as
    JSON Lines with ``multi_line=False``, which is splittable, or through
    ``read_json_array``, which splits an array.
    """
    reader = (
        spark.read.schema(_with_corrupt(contract, corrupt_column))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    if corrupt_column is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(path if isinstance(path, str) else list(path))


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    *,
    schema: T.StructType | None = None,
    merge_schema: bool = True,
    text_partitions: Sequence[str] = (),
    contract: T.StructType | None = None,
) -> DataFrame:
    """Table stored at ``path``; with ``contract`` exactly its columns (see ``conform``).

    With ``schema`` no file is opened to infer one. Without it, Parquet footers
    are merged (``merge_schema``) so that columns added by later appends show
    up. ``text_partitions`` are partition columns to keep as text even when all
    their values look like numbers.
    """
    if contract is not None:
        options = {"schema": schema, "merge_schema": merge_schema, "text_partitions": text_partitions}
        return conform(read_table(spark, path, fmt, **options), contract)
    reader = spark.read.format(fmt)
    if schema is None and fmt == "parquet":
        reader = reader.option("mergeSchema", merge_schema)
    if schema is not None:
        return reader.schema(schema).load(path)
    df = reader.load(path)
    if not text_partitions:
        return df
    kept = T.StructType(
        [
            T.StructField(f.name, T.StringType(), True) if f.name in text_partitions else f
            for f in df.schema.fields
        ]
    )
    return spark.read.format(fmt).schema(kept).load(path)
