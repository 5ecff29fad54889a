"""Raw-table scans: CSV with header, JSON lines (one file or a directory), Parquet lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources import schemas

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Bronze:
    """The five raw tables."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    events: DataFrame


def _permissive(spark: SparkSession, schema: T.StructType, keep_corrupt: bool):
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option(
        "timestampFormat", schemas.TIMESTAMP_FORMAT)
    return reader.option("columnNameOfCorruptRecord", CORRUPT) if keep_corrupt else reader


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header.  Malformed fields become null; `keep_corrupt` also keeps the raw line."""
    return _permissive(spark, schema, keep_corrupt).option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines: a file, a directory of files or a glob; every file split is one task."""
    return _permissive(spark, schema, keep_corrupt).json(path)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed raw lines) of a frame read with `keep_corrupt=True`.

    The test mentions every column: a scan pruned to fewer columns would parse, and reject, fewer fields.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != CORRUPT]
    probe = F.concat(*fields, F.col(CORRUPT))       # null exactly when the raw line was not kept
    return df.filter(probe.isNull()).drop(CORRUPT), df.filter(probe.isNotNull()).select(CORRUPT)


def read_bronze(spark: SparkSession, root: str) -> Bronze:
    """The landing zone: customers/orders/order_items as CSV, products and monthly event logs as JSON lines."""
    return Bronze(
        customers=read_csv(spark, f"{root}/customers.csv", schemas.CUSTOMERS),
        products=read_json_lines(spark, f"{root}/products.jsonl", schemas.PRODUCTS),
        orders=read_csv(spark, f"{root}/orders.csv", schemas.ORDERS),
        order_items=read_csv(spark, f"{root}/order_items.csv", schemas.ORDER_ITEMS),
        events=read_json_lines(spark, f"{root}/events", schemas.EVENTS),
    )


def read_planted_anomalies(spark: SparkSession, path: str) -> DataFrame:
    """Ground-truth days from a metadata JSON object: (date, reason)."""
    schema = "planted_anomalies array<struct<date: string, reason: string>>"
    meta = spark.read.schema(schema).option("multiLine", True).json(path)
    return meta.select(F.inline("planted_anomalies")).select(F.to_date("date").alias("date"), "reason")
