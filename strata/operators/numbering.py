"""Dense numbers for the values of a column, kept over time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.scratch import scratch_dir, scratch_scope


def add_numbers(df: DataFrame, column: str, dictionary: str) -> DataFrame:
    """The dictionary table at ``dictionary`` (``value, number``), after adding the new values of ``df``.

    Numbers start at 0, have no gaps, and never change. New values are sorted over many
    tasks, numbered inside each of them and shifted by the size of the tasks before; what
    meets in one task is one row for each task. Null has no number.
    """
    spark = df.sparkSession
    kind = df.schema[column].dataType
    schema = T.StructType([T.StructField("value", kind), T.StructField("number", T.LongType())])
    try:
        known = spark.read.schema(schema).parquet(dictionary)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], schema)
    start = (known.agg(F.max("number")).first()[0] if known.columns else None)
    start = 0 if start is None else start + 1
    values = df.select(F.col(f"`{column}`").alias("value")).where("value is not null").distinct()
    with scratch_scope(spark):
        placed = scratch_dir(spark, "values")
        new = values.join(known, "value", "left_anti").repartitionByRange("value")
        new.select("value", F.spark_partition_id().alias("part")).write.parquet(placed)
        new = spark.read.schema(T.StructType([schema["value"], T.StructField("part", T.IntegerType())])).parquet(placed)
        sizes = new.groupBy("part").agg(F.count("*").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        shifts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
        place = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
        numbered = new.withColumn("place", place).join(F.broadcast(shifts), "part")
        number = (F.lit(start) + F.col("shift") + F.col("place")).cast("long")
        numbered.select("value", number.alias("number")).write.mode("append").parquet(dictionary)
    return spark.read.schema(schema).parquet(dictionary)
