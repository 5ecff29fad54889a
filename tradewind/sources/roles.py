"""The sample star schema seen as raw retail tables.

One place holds the mapping; the oracle states the same mapping in SQL.  Dirty
variants (blank cities, padded payment names, zero quantities, upper-case event
types) are derived from the keys, so that the cleaning rules have work to do.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.exprs import MONEY
from tradewind.functions.vocab import DEVICES, TRAFFIC_SOURCES

# the five order priorities play the payment methods; the first one is cash on delivery
PAYMENT_VOCABULARY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CASH_ON_DELIVERY = "1-URGENT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _messy(c: Column) -> Column:
    return F.concat(F.lit("  "), F.lower(c), F.lit(" "))


def city_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical city spellings: one row per city."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("city"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, city = F.col("c_custkey"), F.col("n_name")
    geo = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("customer_id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        (18 + key % 50).cast("int").alias("age"),
        F.when(key % 100 == 0, "  ").when(key % 7 == 0, _messy(city)).otherwise(city).alias("city"),
        city.alias("state"),
        F.col("r_name").alias("region"),
        (F.col("n_nationkey") % 3 + 1).cast("int").alias("city_tier"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias("signup_date"),
        F.col("c_mktsegment").alias("acquisition_channel"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"),
        F.col("p_brand").alias("brand"), price.alias("list_price"),
        F.round(price * F.lit("0.6").cast("decimal(2,1)"), 2).cast(MONEY).alias("cost_price"),
        F.date_add(F.lit("1994-01-01").cast("date"), F.col("p_size")).alias("launch_date"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), "Cancelled")
        .when(F.col("o_orderstatus") == "P", "Returned")
        .when(F.col("o_orderstatus") == "O", "Shipped").otherwise("Delivered"))
    payment = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"),
        F.when(key % 40 == 0, _messy(status)).otherwise(status).alias("status"),
        F.when(key % 50 == 0, _messy(payment)).otherwise(payment).alias("payment_method"),
        _pick(DEVICES, key % 3).alias("device"),
        F.when(key % 3 == 0, F.concat(F.lit("SAVE"), (key % 30).cast("string"))).otherwise(" ").alias("coupon_code"),
        F.when(F.col("o_totalprice") < 100000, 49).otherwise(0).cast(MONEY).alias("shipping_fee"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = F.col("l_discount").cast("decimal(4,2)")
    per_unit = F.round(
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(28,8)"), 2).cast(MONEY)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_orderkey") % 700 == 0, 0).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        per_unit.alias("list_price"),
        F.round(per_unit * (1 - discount), 2).cast(MONEY).alias("unit_price"),
        discount.alias("discount_pct"),
        F.when(F.col("l_orderkey") % 100 < 55, 1 + F.col("l_linenumber") % 5).cast("int").alias("rating"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int").getField("k")
    kind = (
        F.when(F.col("event_type") == "view", "product_view").when(F.col("event_type") == "click", "add_to_cart")
        .when(F.col("event_type") == "signup", "checkout").otherwise(F.col("event_type")))
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.col("user_id").alias("customer_id"), ts.alias("event_time"),
        F.when(F.col("event_id") % 30 == 0, F.upper(kind)).otherwise(kind).alias("event_type"),
        F.when(F.col("event_id") % 40 != 7, k.cast("bigint")).alias("product_id"),
        _pick(DEVICES, k % 3).alias("device"), _pick(TRAFFIC_SOURCES, k % 6).alias("traffic_source"),
    )


class SampleBronze:
    """The five raw tables of one sample directory; each is planned only when a query reads it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return products(self.spark, self.sf_dir)

    @cached_property
    def orders(self) -> DataFrame:
        return orders(self.spark, self.sf_dir)

    @cached_property
    def order_items(self) -> DataFrame:
        return order_items(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return events(self.spark, self.sf_dir)
