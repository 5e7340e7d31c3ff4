"""Explicit schemas of the raw inputs and the folder layout of the layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Raw column names, all read as text.
SALES_COLUMNS = (
    "order_id",
    "order_date",
    "customer_id",
    "product_id",
    "product_category",
    "region",
    "sales_amount",
    "quantity",
    "discount",
    "salesperson_id",
)
LOGISTICS_COLUMNS = (
    "shipment_id",
    "order_id",
    "dispatch_date",
    "delivery_date",
    "carrier",
    "origin_city",
    "destination_city",
    "freight_cost",
    "status",
)


def text_contract(columns: tuple[str, ...], required: str) -> T.StructType:
    """All-text schema. File sources ignore nullability; filters enforce it."""
    return T.StructType([T.StructField(c, T.StringType(), c != required) for c in columns])


SALES_CONTRACT = text_contract(SALES_COLUMNS, "order_id")
LOGISTICS_CONTRACT = text_contract(LOGISTICS_COLUMNS, "shipment_id")


def bronze_schema(contract: T.StructType) -> T.StructType:
    """Schema of a bronze table: the contract, corrupt text and audit columns.

    Reading with it needs no footer merge; columns that only some ingestions
    added are then left out.
    """
    audit = {
        CORRUPT_COLUMN: T.StringType(),
        "_ingestion_timestamp": T.TimestampType(),
        "_source_file": T.StringType(),
        "_layer": T.StringType(),
        "_year": T.IntegerType(),
    }
    added = [T.StructField(name, kind, True) for name, kind in audit.items()]
    return T.StructType([*contract.fields, *added])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns: cast, in order, missing ones as null.

    Names match whatever their letter case, as they do in Spark.
    """
    present = {f.name.lower(): f for f in df.schema.fields}

    def value(field: T.StructField) -> Column:
        own = present.get(field.name.lower())
        if own is None:
            return F.lit(None).cast(field.dataType)
        column = F.col(f"`{own.name}`")
        return column if own.dataType == field.dataType else column.try_cast(field.dataType)

    return df.select(*[value(f).alias(f.name) for f in contract.fields])


@dataclass(frozen=True)
class LayerPaths:
    """Where each layer's tables live under one base folder."""

    base: str

    def _at(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def raw(self, table: str) -> str:
        return self._at("raw", table)

    def bronze(self, table: str) -> str:
        return self._at("bronze", table)

    def silver(self, table: str) -> str:
        return self._at("silver", table)

    def gold(self, table: str) -> str:
        return self._at("gold", table)

    def manifest(self, table: str) -> str:
        """List of the raw files that a bronze table holds."""
        return self._at("_manifest", table)
