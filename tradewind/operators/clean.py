"""Cleaning rules as combinators, and the data-quality report."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.exprs import flag
from tradewind.functions.vocab import PAYMENT_METHODS, VALID_EVENTS
from tradewind.sources.readers import Bronze

MAX_CHAINED = 50
ITEM_KEY = ["order_id", "line_no"]


def blank_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Trimmed-empty strings become null; columns of other types pass through."""
    text = {n for n, t in df.dtypes if t == "string"} & set(cols)
    return df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in cols if c in text})


def canonical(c: Column | str, values: list[str]) -> Column:
    """Maps case/space variants onto a short vocabulary, else title-cases the trimmed text."""
    if len(values) > MAX_CHAINED:
        raise ValueError("use canonicalise() with a vocabulary frame for long vocabularies")
    c = F.col(c) if isinstance(c, str) else c
    key = F.lower(F.trim(c))
    matched = [F.when(key == v.lower(), F.lit(v)) for v in values]
    return F.coalesce(*matched, F.initcap(F.trim(c)))


def canonicalise(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """The same rule against a one-column vocabulary frame of any length (one equality join)."""
    spelling = vocabulary.select(F.col(vocabulary.columns[0]).alias("_canonical")).groupBy(
        F.lower(F.trim("_canonical")).alias("_key")).agg(F.min("_canonical").alias("_canonical"))
    keyed = df.withColumn("_key", F.lower(F.trim(column)))
    fixed = F.coalesce("_canonical", F.initcap(F.trim(column)))
    return keyed.join(spelling, "_key", "left").withColumn(column, fixed).select(*df.columns)


def dedupe(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: the smallest by all remaining columns (nulls first), so the survivor never
    depends on the partitioning.

    A minimum is combined map-side, so a key with a third of all rows shuffles no more than any
    other.  Grouping also tells the optimizer that the key is unique: a later left join that only
    looks something up is dropped from queries that do not use the looked-up columns.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.groupBy(*key).agg(F.lit(1).alias("_one")).drop("_one")
    smallest = F.min(F.struct(*rest)).alias("_row")
    return df.groupBy(*key).agg(smallest).select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_rare(df: DataFrame, key: list[str]) -> DataFrame:
    """The same survivors as `dedupe`, for facts, in which few keys repeat.

    Keys are counted first, by a hash aggregate of the keys alone; rows of keys that occur once pass as they are, and only
    the rows of repeated keys are compared.  The repeated keys are unique, so hashing them splits evenly, and a
    third of all rows under one key is still combined map-side.
    """
    if len(key) == len(df.columns):
        return dedupe(df, key)
    once = reduce(and_, [F.col(c).isNotNull() for c in key])
    repeated = df.filter(once).groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).drop("_n")
    looked_up = repeated.hint("shuffle_hash")
    single = df.filter(once).join(looked_up, key, "left_anti")
    compared = df.filter(once).join(looked_up, key, "left_semi").unionByName(df.filter(~once))
    return single.unionByName(dedupe(compared, key))


def dedupe_dealt(df: DataFrame, key: list[str], by: str, parts: int) -> DataFrame:
    """The same survivors as `dedupe`, for a fact that is then joined and written by one column of its key: rows are
    dealt by that column into `parts`, once, and neither grouping nor a join by it shuffles them again."""
    return dedupe(df.repartition(parts, by), key)


def leading(df: DataFrame, key: list[str], used: list[str]) -> DataFrame:
    """The key and the columns up to the last one that is used.  The smallest row by them has the values of the smallest by
    all columns, so that `dedupe` need not carry the others."""
    rest = [c for c in df.columns if c not in key]
    return df.select(*key, *rest[:1 + max(map(rest.index, used))])


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column -> default for nulls; keeps each column's type."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()})


def _required_city(df: DataFrame, vocabulary: DataFrame | list[str]) -> DataFrame:
    df = blank_to_null(df, ["city"])
    if isinstance(vocabulary, list):
        return df.withColumn("city", canonical("city", vocabulary))
    return canonicalise(df, "city", vocabulary)


def clean_customers(raw: DataFrame, cities: DataFrame | list[str]) -> DataFrame:
    one = dedupe(fill_defaults(_required_city(raw, cities), {"city": "Unknown"}), ["customer_id"])
    return one.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))


def with_margin(products: DataFrame) -> DataFrame:
    """margin_pct = 1 - cost/list, as a fraction with 4 digits."""
    cost_share = F.try_divide(F.col("cost_price").cast("double"), F.col("list_price").cast("double"))
    return products.withColumn("margin_pct", F.round((1 - cost_share).cast("decimal(28,8)"), 4).cast("double"))


def clean_products(raw: DataFrame) -> DataFrame:
    return with_margin(dedupe(raw, ["product_id"]).filter(F.col("list_price") > 0))


def clean_orders(raw: DataFrame, payment_methods: list[str] = PAYMENT_METHODS, parts: int | None = None) -> DataFrame:
    """One row per order; with `parts`, dealt by order into that many partitions."""
    tidy = blank_to_null(raw, ["coupon_code"]).withColumns({
        "payment_method": canonical("payment_method", payment_methods),
        "status": F.initcap(F.trim("status")),
    })
    one = dedupe_rare(tidy, ["order_id"]) if parts is None else dedupe_dealt(tidy, ["order_id"], "order_id", parts)
    return one.filter(F.col("order_ts").isNotNull() & F.col("customer_id").isNotNull())


def valid_lines(raw: DataFrame) -> DataFrame:
    return raw.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def clean_order_items(raw: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per order and line; with `parts`, dealt by order into that many partitions."""
    return dedupe_rare(valid_lines(raw), ITEM_KEY) if parts is None else dedupe_dealt(valid_lines(raw), ITEM_KEY, "order_id", parts)


def normalise_events(raw: DataFrame) -> DataFrame:
    optional = [c for c in ("product_id", "order_id") if c in raw.columns]
    tidy = blank_to_null(raw, optional).withColumn("event_type", F.lower(F.trim("event_type")))
    return dedupe_rare(tidy, ["event_id"])


def valid_events(events: DataFrame, vocabulary: list[str] = VALID_EVENTS) -> DataFrame:
    """Known event types only; a product view must name its product."""
    blind_view = (F.col("event_type") == "product_view") & F.col("product_id").isNull()
    return events.filter(F.col("event_type").isin(*vocabulary)).filter(~blind_view)


def clean_events(raw: DataFrame) -> DataFrame:
    return valid_events(normalise_events(raw))


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(flag(cond)), F.lit(0)).cast("bigint")


def _distinct_rows(df: DataFrame, key: list[str], **counters: Column) -> DataFrame:
    """Per-key partial counts: raw rows, plus counters; a hot key is combined map-side."""
    return df.groupBy(*key).agg(
        F.count("*").alias("_rows"), *[c.alias(n) for n, c in counters.items()])


def _long(one_row: DataFrame, name: str) -> DataFrame:
    metrics = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in one_row.columns])
    return one_row.select(F.lit(name).alias("table_name"), F.inline(metrics))


def dq_report(
    bronze: Bronze, payment_methods: list[str] = PAYMENT_METHODS, event_types: list[str] = VALID_EVENTS,
) -> DataFrame:
    """(table_name, metric, value): raw/clean rows, duplicates, fills, standardised and invalid values.

    One grouped pass per table: a key's duplicates collapse map-side and the
    second aggregate only sums counters.
    """
    total = F.sum("_rows")
    keys = F.count("*")

    customers = _distinct_rows(
        bronze.customers, ["customer_id"],
        missing=_count_if(F.col("city").isNull() | (F.trim("city") == "")),
    ).agg(
        total.alias("raw"), keys.alias("clean"), (total - keys).alias("duplicates_removed"),
        F.sum("missing").alias("missing_city_filled"))

    # a key survives when the price of its surviving (smallest) row is valid
    products = dedupe(bronze.products, ["product_id"]).agg(_count_if(F.col("list_price") > 0).alias("clean"))
    raw_products = bronze.products.agg(F.count("*").alias("raw")).scalar()
    products = products.select(
        raw_products.alias("raw"), "clean", (raw_products - F.col("clean")).alias("invalid_removed"))

    orders = dedupe(bronze.orders, ["order_id"]).agg(_count_if(F.col("order_ts").isNotNull() & F.col("customer_id").isNotNull()).alias("clean"))
    order_counts = bronze.orders.agg(
        F.count("*").alias("n"), _count_if(~F.col("payment_method").isin(*payment_methods)).alias("odd"))
    orders = orders.withColumn("o", order_counts.select(F.struct("n", "odd")).scalar()).select(
        F.col("o.n").alias("raw"), "clean", (F.col("o.n") - F.col("clean")).alias("duplicates_removed"),
        F.col("o.odd").alias("payment_values_standardised"))

    ok_line = (F.col("quantity") > 0) & (F.col("unit_price") > 0)
    items = _distinct_rows(
        bronze.order_items, ["order_id", "line_no"],
        valid=F.max(flag(ok_line)),
        bad=_count_if((F.col("quantity") <= 0) | F.col("quantity").isNull()),
    ).agg(
        total.alias("raw"), F.sum("valid").alias("clean"), F.sum("bad").alias("invalid_quantity_removed"))

    raw_events = bronze.events.agg(
        F.count("*").alias("n"), _count_if(F.col("event_type") != F.lower("event_type")).alias("upper"))
    kept = normalise_events(bronze.events)
    blind = (F.col("event_type") == "product_view") & F.col("product_id").isNull()
    events = kept.agg(
        F.count("*").alias("after_dup"),
        _count_if(F.col("event_type").isin(*event_types) & ~blind).alias("clean"),
    ).withColumn("e", raw_events.select(F.struct("n", "upper")).scalar()).select(
        F.col("e.n").alias("raw"), "clean", (F.col("e.n") - F.col("after_dup")).alias("duplicates_removed"),
        F.col("e.upper").alias("event_type_case_fixed"),
        (F.col("after_dup") - F.col("clean")).alias("invalid_removed"))

    parts = [
        _long(customers, "customers"), _long(products, "products"), _long(orders, "orders"),
        _long(items, "order_items"), _long(events, "events"),
    ]
    return reduce(DataFrame.unionByName, parts)

