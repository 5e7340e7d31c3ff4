"""One huge JSON array, read by many tasks.

Spark reads a multi-line JSON file in one task. Here the file is read as text that ends at
every ``}``, which Spark splits at byte ranges like lines. Whether such a brace closes a
record depends on all text before it: on quotes (is it inside a string?) and on nesting.
Both are sums, so they are found as sums are: each piece says how it changes the state,
the changes are added up inside each byte range, and the ranges' totals, one row each,
over the file. Pieces between two ends of records are then put together and parsed.

Escaped quotes and braces, braces in strings and nested values are respected. A record that
cannot be parsed is kept in the corrupt column and costs no other record, which is more than
a read of the whole file gives. Text that breaks the array itself (a string that does not
end) spoils what follows it in the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.contracts import CORRUPT_COLUMN


def _count(text: Column, characters: str) -> Column:
    """How often any of ``characters`` stands in ``text``."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _pieces(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text up to each ``}``: file, byte range, place in it, and what the piece does to the state."""
    lines = spark.read.option("lineSep", "}").text(path if isinstance(path, str) else list(path))
    text = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    # An escaped character is none of interest; one at the end of a piece escapes the brace.
    parts = F.split(F.regexp_replace("text", r"\\(?s:.|\z)", ""), '"')
    plain = text.withColumn("parts", parts)
    for name, odd in (("outside", 0), ("inside", 1)):  # what lies outside strings if the piece starts so
        joined = F.expr(f"array_join(filter(parts, (part, i) -> i % 2 = {odd}), '')")
        plain = plain.withColumn(name, _count(joined, "{[") - _count(joined, "]"))
    return plain.select("file", "block", "at", "text", (F.size("parts") - 1).alias("quotes"), "outside", "inside")


def _before(value: str, total: str, offsets: DataFrame, pieces: DataFrame) -> DataFrame:
    """``pieces`` with the sum of ``value`` over all earlier pieces of the file, as ``total``."""
    ahead = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.join(F.broadcast(offsets), ["file", "block"]).withColumn(
        total, F.coalesce(F.sum(value).over(ahead), F.lit(0)) + F.col("offset")
    ).drop("offset")


def _offsets(pieces: DataFrame, value: str) -> DataFrame:
    """For each byte range, the sum of ``value`` over the ranges before it: a row for each range of the scan."""
    blocks = pieces.groupBy("file", "block").agg(F.sum(value).alias("own"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("offset"))


def split_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, number, record``: the text of each element of the arrays at ``path``."""
    pieces = _pieces(spark, path)
    stated = _before("quotes", "quoted", _offsets(pieces, "quotes"), pieces)
    starts_outside = F.col("quoted") % 2 == 0
    ends_outside = (F.col("quoted") + F.col("quotes")) % 2 == 0
    step = F.when(starts_outside, F.col("outside")).otherwise(F.col("inside")) - F.when(ends_outside, 1).otherwise(0)
    stepped = stated.select("file", "block", "at", "text", step.alias("step"), ends_outside.alias("closes"))
    deep = _before("step", "depth", _offsets(stepped, "step"), stepped)
    ends = (F.col("closes") & (F.col("depth") + F.col("step") == 1)).cast("int")
    ended = deep.select("file", "block", "at", "text", ends.alias("ends"))
    numbered = _before("ends", "number", _offsets(ended, "ends"), ended)
    # A record's pieces are few; records are dealt evenly, whatever the file they come from.
    place = F.struct("block", "at", "text", "ends")
    whole = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(place)).alias("p"))
    text = F.concat(F.array_join(F.transform("p", lambda p: p["text"]), "}"), F.lit("}"))
    complete = whole.where(F.exists("p", lambda p: p["ends"] == 1))
    return complete.select("file", "number", F.regexp_replace(text, r"^[\s,\[]+", "").alias("record"))


def read_json_array(
    spark: SparkSession, path: str | Sequence[str], contract: T.StructType, *, corrupt_column: str | None = CORRUPT_COLUMN
) -> DataFrame:
    """Records of huge JSON arrays under ``contract``, as ``read_json_contract`` gives them.

    One shuffle of the text brings the pieces of each record together.
    """
    fields = [*contract.fields]
    if corrupt_column is not None:
        fields.append(T.StructField(corrupt_column, T.StringType(), True))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    options = {"mode": "PERMISSIVE"}
    if corrupt_column is not None:
        options["columnNameOfCorruptRecord"] = corrupt_column
    parsed = split_records(spark, path).select(F.from_json("record", schema, options).alias("r"))
    return parsed.select("r.*")
