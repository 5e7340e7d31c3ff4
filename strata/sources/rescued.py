"""JSON under a contract, without losing what the contract does not say.

Fields that the contract does not know, and values that its types cannot hold, land in a
variant column instead of disappearing: producers may add and rename fields, and nothing
has to be read again to find out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.contracts import CORRUPT_COLUMN, conform
from strata.sources.json_split import split_records

RESCUED = "_rescued_data"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _held(value: str, kind: T.DataType) -> str:
    """SQL for a variant as ``kind``; null where it has another shape. Text holds any single value."""
    typed = f"try_variant_get({value}, '$', {_quoted(kind.simpleString())})"
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return typed
    return f"if(schema_of_variant({value}) RLIKE '^(OBJECT|ARRAY)', NULL, {typed})"


def rescue(
    records: DataFrame,
    contract: T.StructType,
    *,
    text: str = "record",
    renamed: Mapping[str, str] | None = None,
    rescued: str = RESCUED,
    corrupt: str = CORRUPT_COLUMN,
) -> DataFrame:
    """Columns of the contract, ``rescued`` and ``corrupt`` from JSON text.

    Fields match the contract's names in any letter case; ``renamed`` gives further names
    (a record's field to a column). A missing field is null. Of several fields for a column
    the first by name with a value that the column holds fills it. Everything else is in
    ``rescued``, a variant object with the fields' own names; it is null if nothing is left.
    Text that is no JSON object is in ``corrupt``.
    """
    names = {f.name.lower(): f.name for f in contract.fields}
    names |= {old.lower(): new for old, new in (renamed or {}).items()}
    column_of = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    parsed = records.select(F.col(text).alias("text"), F.try_parse_json(text).alias("v"), column_of.alias("column_of"))
    is_object = F.expr("coalesce(schema_of_variant(v) LIKE 'OBJECT%', false)")
    fields = parsed.select("text", "column_of", is_object.alias("good"), F.expr("try_variant_get(v, '$', 'map<string, variant>')").alias("m"))
    keyed = fields.withColumn("fields", F.when(F.col("good"), F.array_sort(F.map_keys("m"))))
    chosen = {
        f"k{i}": F.expr(f"get(filter(fields, k -> column_of[lower(k)] = {_quoted(f.name)} AND ({_held('m[k]', f.dataType)}) IS NOT NULL), 0)")
        for i, f in enumerate(contract.fields)
    }
    picked = keyed.withColumns(chosen)
    used = ", ".join(chosen) or "cast(NULL AS string)"
    null_of_column = "column_of[lower(k)] IS NOT NULL AND is_variant_null(m[k])"
    left = F.expr(f"filter(fields, k -> NOT array_contains(array_compact(array({used})), k) AND NOT ({null_of_column}))")
    rest = picked.withColumn("rest", left)
    values = [F.expr(_held(f"m[k{i}]", f.dataType)).alias(f.name) for i, f in enumerate(contract.fields)]
    more = F.expr("if(size(rest) > 0, to_variant_object(map_from_arrays(rest, transform(rest, k -> m[k]))), NULL)")
    extra = [more.alias(rescued), F.when(~F.col("good"), F.col("text")).alias(corrupt)]
    out = T.StructType([*contract.fields, T.StructField(rescued, T.VariantType()), T.StructField(corrupt, T.StringType())])
    return conform(rest.select(*values, *extra), out)


def read_json_rescued(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: T.StructType,
    *,
    arrays: bool = False,
    renamed: Mapping[str, str] | None = None,
) -> DataFrame:
    """``rescue`` of JSON Lines, or of the records of (huge) JSON arrays."""
    if arrays:
        records = split_records(spark, path).select("record")
    else:
        records = spark.read.text(path if isinstance(path, str) else list(path)).select(F.col("value").alias("record"))
    return rescue(records.where(F.trim("record") != ""), contract, renamed=renamed)
