"""Raw sales and logistics derived from the driver's tables.

Defects (mixed date layouts, money and percent text, blanks, stale copies,
repeated shipments) are planted by key arithmetic, so DuckDB can restate the
expected clean values directly from the tables (``oracles.py``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.contracts import LOGISTICS_COLUMNS, SALES_COLUMNS

CURRENT_BATCH = datetime(2024, 1, 2)
STALE_BATCH = datetime(2024, 1, 1)
LOGISTICS_TIES = ("_tb1", "_tb2", "_tb3")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def every(number: Column, step: int, rest: int = 0) -> Column:
    return number % step == rest


def blank_every(number: Column, step: int, value: Column) -> Column:
    return F.when(~every(number, step), value)


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's segment and region."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("day", F.col("o_orderdate").cast("date"))
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales: the current batch plus stale copies of every fiftieth order."""
    k = F.col("o_orderkey")
    price = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    date_text = (
        F.when(every(k, 89), F.lit("not-a-date"))
        .when(every(k, 3), F.date_format("day", "yyyy-MM-dd"))
        .when(every(k, 3, 1), F.date_format("day", "dd/MM/yyyy"))
        .otherwise(F.date_format("day", "MM-dd-yyyy"))
    )
    money_text = F.when(every(k, 103), F.lit("n/a")).otherwise(F.concat(F.lit("$"), price))
    ragged = F.concat(F.lit(" "), F.lower("r_name"), F.lit("  "))
    region = F.when(every(k, 2), ragged).otherwise(F.col("r_name"))
    discount = F.concat(((k % 5) * 5).cast("string"), F.lit("%"))
    current = customer_orders(spark, sf_dir).select(
        k.alias("k"),
        padded("ORD-", k, 9).alias("order_id"),
        blank_every(k, 97, date_text).alias("order_date"),
        F.concat(padded(" cli-", F.col("o_custkey"), 9), F.lit(" ")).alias("customer_id"),
        F.concat(F.lit("PRD-"), (k % 200).cast("string")).alias("product_id"),
        blank_every(k, 53, F.lower("c_mktsegment")).alias("product_category"),
        blank_every(k, 59, region).alias("region"),
        blank_every(k, 101, money_text).alias("sales_amount"),
        (k % 20 + 1).cast("string").alias("quantity"),
        blank_every(k, 11, discount).alias("discount"),
        F.concat(F.lit("ven-"), (k % 30).cast("string")).alias("salesperson_id"),
    )
    # One scan emits both batches: an order's stale copy is a second array element.
    batches = F.when(every(F.col("k"), 50, 1), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    copies = current.withColumn("stale", F.explode(batches))
    return copies.select(
        *[
            F.when(F.col("stale"), F.lit("$1.00")).otherwise(F.col(c)).alias(c)
            if c == "sales_amount"
            else F.col(c)
            for c in SALES_COLUMNS
        ],
        F.when(F.col("stale"), F.lit(STALE_BATCH).cast("timestamp"))
        .otherwise(F.lit(CURRENT_BATCH).cast("timestamp"))
        .alias("_ingestion_timestamp"),
    )


def pick(number: Column, *values: object) -> Column:
    """Element of ``values`` chosen by the remainder of ``number``."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def logistics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shipments, one per line item; line numbers repeat within orders."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    supplier, part = F.col("l_suppkey"), F.col("l_partkey")
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
        ),
        order == F.col("o_orderkey"),
    )
    slowest = pick(supplier, 7, 7, 8, 10, 20)
    days = (1 + (part + line) % slowest).cast("int")
    delivery = F.date_format(F.date_add("day", days), "yyyy-MM-dd")
    dispatch = F.when(every(order, 2), F.date_format("day", "yyyy-MM-dd")).otherwise(
        F.date_format("day", "dd/MM/yyyy")
    )
    status = (
        F.when(F.col("l_returnflag").isin("R", "A"), F.lit("entregue"))
        .when(F.col("l_linestatus") == "F", F.lit("ATRASADO"))
        .otherwise(F.lit("EM_TRANSITO"))
    )
    freight = (F.col("l_quantity") * F.lit(7.25)).cast("decimal(10,2)").cast("string")
    return lines.select(
        padded("SHP-", order * 10 + line, 10).alias("shipment_id"),
        padded("ORD-", order, 9).alias("order_id"),
        dispatch.alias("dispatch_date"),
        blank_every(order * 7 + line, 20, delivery).alias("delivery_date"),
        F.concat(F.lit(" carrier-"), (supplier % 5).cast("string")).alias("carrier"),
        pick(supplier, "são paulo", "recife", "manaus").alias("origin_city"),
        pick(part, "goiânia", "salvador").alias("destination_city"),
        freight.alias("freight_cost"),
        status.alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("_ingestion_timestamp"),
        part.alias("_tb1"),
        supplier.alias("_tb2"),
        F.col("l_extendedprice").alias("_tb3"),
    )


def write_sales_csv(df: DataFrame, path: str) -> None:
    """Raw sales as CSV files with a header, text kept as it is."""
    (
        df.select(*SALES_COLUMNS)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


#: Rows in a file of raw shipments.
FILE_ROWS = 20_000


def write_logistics_json(df: DataFrame, path: str) -> None:
    """Raw logistics as files that each hold one JSON array over many lines.

    The files are dealt by shipment, in one shuffle; a file's rows, a bounded number, are
    gathered by the task that writes it. They are compressed: an array is read by one task anyway.
    """
    rows = df.select(
        *[F.col(c) for c in LOGISTICS_COLUMNS if c != "freight_cost"],
        F.col("freight_cost").cast("double").alias("freight_cost"),
    )
    files = max(1, df.count() // FILE_ROWS)
    lines = rows.select(F.pmod(F.xxhash64("shipment_id"), F.lit(files)).cast("int").alias("part"), F.to_json(F.struct("*")).alias("line"))
    dealt = lines.repartitionById(files, F.col("part"))  # one array a file; rows are gathered where they were dealt
    arrays = dealt.groupBy("part").agg(F.array_join(F.collect_list("line"), ",\n").alias("lines"))
    arrays.select(F.concat(F.lit("["), "lines", F.lit("]")).alias("value")).write.text(path, compression="lz4")


def write_json_array(df: DataFrame, path: str) -> None:
    """A record with the status ``first`` and all rows as one JSON array in a single file.

    The one task that writes the file streams the rows; it holds none of them.
    """
    spark = df.sparkSession
    line = F.concat(F.lit(", "), F.to_json(F.struct("*")))
    ends = [spark.range(1).select(F.lit(text).alias("value")) for text in ('[ {"status": "first"}', "]")]
    ends[0].union(df.select(line)).union(ends[1]).coalesce(1).write.text(path)
