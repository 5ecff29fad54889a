"""The enriched silver tables: lines, order totals, orders, sessions, as-of dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.exprs import MONEY, flag, is_revenue
from tradewind.functions.calendar import month_key
from tradewind.sources.scratch import cut_lineage


def as_of_date(orders: DataFrame) -> DataFrame:
    return orders.agg(F.max("order_date").alias("as_of"))


CATALOGUE = ["product_name", "category", "sub_category", "brand", "cost_price"]


def priced_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Cleaned items with catalogue attributes and the five money columns (products must exist)."""
    return with_money(items.join(products.select("product_id", *CATALOGUE), "product_id"))


def with_money(items: DataFrame) -> DataFrame:
    """The five money columns of items whose cost price is known."""
    qty = F.col("quantity")
    return (
        items.withColumn("revenue", (qty * F.col("unit_price")).cast(MONEY))
        .withColumn("gross_value", (qty * F.col("list_price")).cast(MONEY))
        .withColumn("cost", (qty * F.col("cost_price")).cast(MONEY))
        .withColumn("profit", (F.col("revenue") - F.col("cost")).cast(MONEY))
        .withColumn("discount_amount", (F.col("gross_value") - F.col("revenue")).cast(MONEY))
    )


def silver_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Line fact: items x orders x products, with order date and the revenue flag."""
    return with_header(priced_items(items, products), orders)


def with_header(priced: DataFrame, orders: DataFrame) -> DataFrame:
    """Priced items of known orders, with what a line has of its order."""
    header = orders.select("order_id", "customer_id", "order_ts", "status", "payment_method", "device")
    return (
        priced.join(header, "order_id")
        .withColumn("order_date", F.to_date("order_ts"))
        .withColumn("is_revenue", is_revenue())
    )


def order_sums(priced: DataFrame) -> DataFrame:
    """Per-order sums of the rounded line values, summed map-side before the shuffle."""
    return priced.groupBy("order_id").agg(*_sums())


def order_categories(priced: DataFrame) -> DataFrame:
    return priced.groupBy("order_id").agg(_categories())


def order_totals(priced: DataFrame) -> DataFrame:
    """The sums and the sorted categories of each order."""
    return priced.groupBy("order_id").agg(*_sums(), _categories())


def _sums() -> list[Column]:
    return [
        F.count("*").alias("items_count"),
        F.sum("quantity").alias("units"),
        *[F.sum(c).cast(MONEY).alias(out) for c, out in (
            ("gross_value", "gross_value"), ("revenue", "net_amount"),
            ("discount_amount", "discount_amount"), ("profit", "profit"))]]


def _categories() -> Column:
    return F.array_sort(F.collect_set("category")).alias("categories")


GEO = ["city", "state", "region", "city_tier"]


def _with_flags(orders: DataFrame) -> DataFrame:
    return (
        orders.withColumn("order_date", F.to_date("order_ts"))
        .withColumn("order_month", month_key("order_ts"))
        .withColumn("is_revenue", is_revenue())
        .withColumn("coupon_used", F.col("coupon_code").isNotNull())
    )


def silver_orders(orders: DataFrame, totals: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with at least one valid line, their totals and the customer's geography."""
    geo = customers.select("customer_id", *GEO)
    return _with_flags(orders.join(totals, "order_id").join(geo, "customer_id", "left"))


def order_facts(orders: DataFrame, sums: DataFrame) -> DataFrame:
    """What `silver_orders` has without looking up customers or listing categories."""
    return _with_flags(orders.join(sums, "order_id"))


def looked_up_orders(facts: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """The columns of `silver_orders` from written facts.  Both sides that are looked up have one row per key by a grouping, so the
    optimizer drops the joins from queries that use none of their columns."""
    found = facts.join(order_categories(lines), "order_id", "left").join(customers.select("customer_id", *GEO), "customer_id", "left")
    flags = ["order_date", "order_month", "is_revenue", "coupon_used"]
    first = ["customer_id", "order_id"]
    return found.select(*first, *[c for c in facts.columns if c not in (*first, *flags)], "categories", *GEO, *flags)


def with_catalogue(items: DataFrame, products: DataFrame, columns: list[str]) -> DataFrame:
    """Items with columns of their product; `in_catalogue` is null where there is no such product.  Looked up before items are
    dealt by order, so that even a catalogue too large to broadcast costs one more shuffle of them, not two.  What is looked up
    follows the product, and comes last, so it decides nothing about repeated rows."""
    catalogue = products.select("product_id", *columns, F.lit(True).alias("in_catalogue"))
    return items.join(catalogue, "product_id", "left").select(*items.columns, *columns, "in_catalogue")


def with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    return with_catalogue(items, products, ["category"])


def with_geography(orders: DataFrame, customers: DataFrame, columns: list[str] = GEO) -> DataFrame:
    """Raw orders with columns of their customer, looked up before orders are dealt; the same holds for repeated rows."""
    return orders.join(customers.select("customer_id", *columns), "customer_id", "left").select(*orders.columns, *columns)


def order_purchases(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with at least one valid line: what customers' histories are made of, the sums of their lines' rounded values, and
    `bought`, the revenue of each of their categories."""
    qty = F.col("quantity")
    values = {"gross_value": F.sum((qty * F.col("list_price")).cast(MONEY)), "revenue": F.sum((qty * F.col("unit_price")).cast(MONEY))}
    by_category = items.groupBy("order_id", "category").agg(*[v.alias(c) for c, v in values.items()])
    totals = by_category.groupBy("order_id").agg(
        F.sum("gross_value").cast(MONEY).alias("gross_value"), F.sum("revenue").cast(MONEY).alias("net_amount"),
        F.sum(F.col("gross_value") - F.col("revenue")).cast(MONEY).alias("discount_amount"),
        F.collect_list(F.struct("category", "revenue")).alias("bought"))
    return orders.join(totals, "order_id").select(
        "order_id", "customer_id", F.to_date("order_ts").alias("order_date"), "status", "payment_method", "device",
        is_revenue().alias("is_revenue"), "gross_value", "net_amount", "discount_amount", "bought")


def purchases(orders: DataFrame) -> DataFrame:
    """The categories of each order with their revenue, a row each, from `order_purchases`: what lines are to a customer's history."""
    return orders.select("order_id", "customer_id", "order_date", "status", "is_revenue", F.inline("bought"))


def _session_measures() -> list[Column]:
    first = F.struct("event_time", "event_id", "device", "traffic_source")
    return [
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.count("*").alias("events"),
        F.sum(flag(F.col("event_type") == "product_view")).alias("product_views"),
        F.max(flag(F.col("event_type") == "add_to_cart")).alias("has_cart"),
        F.max(flag(F.col("event_type") == "checkout")).alias("has_checkout"),
        F.max(flag(F.col("event_type") == "purchase")).alias("has_purchase"),
        F.min(first).alias("_first"),
    ]


def _merge_measures() -> list[Column]:
    return [
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.sum("events").alias("events"), F.sum("product_views").alias("product_views"),
        *[F.max(c).alias(c) for c in ("has_cart", "has_checkout", "has_purchase")],
        F.min("_first").alias("_first"),
    ]


def _finish_sessions(rolled: DataFrame) -> DataFrame:
    return (
        rolled.withColumn("device", F.col("_first.device"))
        .withColumn("traffic_source", F.col("_first.traffic_source")).drop("_first")
        .withColumn("duration_sec", F.unix_timestamp("end_time") - F.unix_timestamp("start_time"))
        .withColumn("has_view", flag(F.col("product_views") > 0))
        .withColumn("is_bounce", flag(F.col("events") == 1))
        .withColumn("session_date", F.to_date("start_time"))
    )


def session_rollup(events: DataFrame) -> DataFrame:
    """Sessions of a click-stream that carries session ids.  Attributes come from the first
    event by (time, id)."""
    rolled = events.groupBy("session_id").agg(
        F.min(F.struct("event_time", "event_id", "customer_id")).alias("_who"), *_session_measures())
    return _finish_sessions(rolled.withColumn("customer_id", F.col("_who.customer_id")).drop("_who"))


def sessionise(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions of a click-stream without ids: a new one starts after `gap_seconds` of silence.

    Two events of a customer inside one time slot of length `gap_seconds` are always in the same
    session, so events are first summed per (customer, slot), map-side.  The slot summaries are sorted by range
    partition, so a customer with a third of all events lies in several tasks; each finds the silences inside its range, and what
    crosses a range's end is stitched from one summary per range.  An event without a customer is a session of its own; it is
    summed and sorted with the others, so that events are read once.
    """
    micros = gap_seconds * 1_000_000
    known = F.col("customer_id").isNotNull()
    slots = events.groupBy(
        "customer_id", F.when(known, F.floor(F.unix_micros("event_time") / F.lit(micros))).alias("_slot"),
        F.when(~known, F.col("event_id")).alias("_own"),
    ).agg(*_session_measures())
    placed = sorted_ranges(slots)
    numbered = _numbered_sessions(placed.filter(known).drop("_own"), micros)
    rolled = numbered.groupBy("customer_id", "session_no").agg(*_merge_measures())
    own = rolled.withColumn("session_id", F.concat_ws("-", F.col("customer_id").cast("string"), F.col("session_no").cast("string")))
    unknown = placed.filter(~known).select(
        "customer_id", F.lit(None).cast("bigint").alias("session_no"),
        *[c for c in rolled.columns if c not in ("customer_id", "session_no")],
        F.concat_ws("-", F.lit("event"), F.col("_own").cast("string")).alias("session_id"))
    return _finish_sessions(own.unionByName(unknown)).drop("session_no")


def sorted_ranges(slots: DataFrame) -> DataFrame:
    """Slot summaries in the order (customer, time), with their range `_part`.  Materialised once, as range bounds are sampled."""
    ordered = cut_lineage(slots.orderBy("customer_id", "start_time").withColumn("_pos", F.monotonically_increasing_id()))
    return ordered.withColumn("_part", F.shiftright("_pos", 33))


def _numbered_sessions(placed: DataFrame, micros: int) -> DataFrame:
    """Sorted slots with `session_no`, counted per customer over all ranges."""
    inside = Window.partitionBy("_part", "customer_id").orderBy("_pos")
    silent = lambda before: F.unix_micros("start_time") - F.unix_micros(before) >= micros
    # null for the first slot of a customer in a range: that depends on earlier ranges
    marked = placed.withColumn("_new", silent(F.lag("end_time").over(inside)))
    runs = marked.groupBy("_part", "customer_id").agg(
        F.min("_pos").alias("_at"), F.min("start_time").alias("start_time"), F.max("end_time").alias("_end"), F.sum(flag(F.col("_new"))).alias("_inner"))
    # only the first and the last customer of a range can be in another one too: two rows a range
    edges = Window.partitionBy("_part")
    touching = cut_lineage(runs.withColumns({"_first": F.min("_at").over(edges), "_last": F.max("_at").over(edges)}).filter(
        (F.col("_at") == F.col("_first")) | (F.col("_at") == F.col("_last"))))
    earlier = Window.partitionBy("customer_id").orderBy("_part")
    starts = touching.withColumn("_new", flag(F.coalesce(silent(F.lag("_end").over(earlier)), F.lit(True))))
    before = F.coalesce(F.sum(F.col("_new") + F.col("_inner")).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stitched = starts.select("_part", "customer_id", F.col("_new").alias("_begins"), before.alias("_before"))
    total = F.sum(flag(F.col("_new"))).over(inside)
    # two rows a range: a proven bound for the broadcast
    return marked.join(F.broadcast(stitched), ["_part", "customer_id"], "left").withColumn(
        "session_no", (total + F.coalesce("_begins", F.lit(1)) + F.coalesce("_before", F.lit(0))).cast("bigint")).drop(
        "_part", "_pos", "_new", "_begins", "_before")
