"""Bronze -> silver as lazy tables, and the Parquet lake between silver and gold."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.calendar import month_key
from tradewind.functions.vocab import CITY_COORDINATES, PAYMENT_METHODS
from tradewind.operators import clean, silver
from tradewind.sources.readers import Bronze
from tradewind.sources.scratch import freed_shuffles
from tradewind.sources.sinks import read_bucketed, write_bucketed, write_lake

TABLES = ("customers", "products", "orders", "lines", "events", "sessions")
LAKE_COMPRESSION = "zstd"
# facts lie in folders by period and, in each, in buckets by order: table -> (partition column, bucket column)
LAKE_LAYOUT = {"orders": ("order_month", "order_id"), "lines": ("order_month", "order_id")}


class _AsOf:
    orders: DataFrame
    lines: DataFrame
    sessions: DataFrame

    @property
    def as_of(self) -> Column:
        """Latest order date of any status, as a scalar subquery."""
        return silver.as_of_date(self.orders).scalar()

    @property
    def purchases(self) -> DataFrame:
        """What customers' histories need of lines: customer, day, revenue flag, category and revenue."""
        return self.lines

    @property
    def session_as_of(self) -> Column:
        return self.sessions.agg(F.max("session_date").alias("as_of")).scalar()


class Silver(_AsOf):
    """The cleaned, enriched tables of a raw data set.  Only the tables a query touches are planned."""

    def __init__(
        self,
        bronze: Bronze,
        cities: DataFrame | list[str] | None = None,
        payment_methods: list[str] = PAYMENT_METHODS,
        sessions: Callable[[DataFrame], DataFrame] = silver.session_rollup,
    ):
        self.bronze = bronze
        self.cities = cities if cities is not None else [c for c, *_ in CITY_COORDINATES]
        self.payment_methods = payment_methods
        self.sessions_of = sessions

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.bronze.customers, self.cities)

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self.bronze.products)

    @cached_property
    def clean_orders(self) -> DataFrame:
        return clean.clean_orders(self.bronze.orders, self.payment_methods)

    @cached_property
    def items(self) -> DataFrame:
        return clean.clean_order_items(self.bronze.order_items)

    @cached_property
    def events(self) -> DataFrame:
        return clean.clean_events(self.bronze.events)

    @cached_property
    def lines(self) -> DataFrame:
        return silver.silver_lines(self.items, self.clean_orders, self.products)

    @cached_property
    def orders(self) -> DataFrame:
        return self.orders_from(silver.priced_items(self.items, self.products))

    def orders_from(self, priced: DataFrame) -> DataFrame:
        """Orders with totals of priced items.  Written lines serve as well: an item without an
        order, which they lack, belongs to no order here either."""
        return silver.silver_orders(self.clean_orders, silver.order_totals(priced), self.customers)

    @cached_property
    def sessions(self) -> DataFrame:
        return self.sessions_of(self.events)


def _buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions: a table of that many buckets joins with a shuffled one bucket by bucket."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Lake(_AsOf):
    """The same tables read back from the Parquet lake, with partition pruning and column pruning."""

    def __init__(self, spark: SparkSession, root: str):
        buckets = spark.read.json(f"{root}/layout").first()["buckets"]
        for name in TABLES:
            layout = LAKE_LAYOUT.get(name)
            path = f"{root}/{name}"
            setattr(self, name, read_bucketed(spark, path, *layout, buckets) if layout else spark.read.parquet(path))

    def period(self, name: str, start: Column, end: Column) -> DataFrame:
        """A fact's rows of the days from `start` to `end`; only the folders of their months are read."""
        month, _ = LAKE_LAYOUT[name]
        inside = F.col(month).between(month_key(start), month_key(end))
        return getattr(self, name).filter(inside & F.col("order_date").between(start, end))


class Dealt(Silver):
    """The same orders and lines for queries that read both once, by order, and write nothing: what they look up (`GEO_USED`,
    `CATALOGUE_USED`) is looked up in raw rows, which are then dealt by order once.  Repeated rows are dropped, sums taken and
    both tables joined where they lie.  Orders have no categories."""

    GEO_USED, CATALOGUE_USED = ["city", "state"], ["product_name", "category", "cost_price"]

    def __init__(self, spark: SparkSession, tables: Silver):
        super().__init__(tables.bronze, tables.cities, tables.payment_methods, tables.sessions_of)
        self._parts = _buckets(spark)

    @cached_property
    def clean_orders(self) -> DataFrame:
        return dealt_orders(self, self._parts, self.GEO_USED)

    @cached_property
    def _priced(self) -> DataFrame:
        return dealt_priced(self, self._parts, self.CATALOGUE_USED)

    @cached_property
    def lines(self) -> DataFrame:
        return silver.with_header(self._priced, self.clean_orders)

    @cached_property
    def orders(self) -> DataFrame:
        return silver.order_facts(self.clean_orders, silver.order_sums(self._priced))


def dealt_orders(tables: Silver, parts: int, geo: list[str] = silver.GEO) -> DataFrame:
    """Clean orders with their customers' geography, dealt by order."""
    return clean.clean_orders(silver.with_geography(tables.bronze.orders, tables.customers, geo), tables.payment_methods, parts)


def dealt_priced(tables: Silver, parts: int, catalogue: list[str] = silver.CATALOGUE) -> DataFrame:
    """Clean, priced items with columns of their products, dealt by order."""
    known = silver.with_catalogue(clean.valid_lines(tables.bronze.order_items), tables.products, catalogue)
    one = clean.dedupe_dealt(known, clean.ITEM_KEY, "order_id", parts)
    return silver.with_money(one.filter("in_catalogue").drop("in_catalogue"))


class Staged(_AsOf):
    """Silver tables for work that reads them many times: each is written to `root` as Parquet when
    first used and read back from there, so it is cleaned and joined once and later scans are
    pruned to the columns they need.  Lines and orders are bucketed by order, so their joins need no shuffle: both are
    dealt by order once, before repeated rows are dropped, and stay so until they are written.  An order's
    geography and categories are looked up by the queries that use them.  The files go when the application ends."""

    def __init__(self, spark: SparkSession, tables: Silver, root: str):
        self._spark, self._tables, self._root = spark, tables, root

    @cached_property
    def _dealt_orders(self) -> DataFrame:
        return clean.clean_orders(self._tables.bronze.orders, self._tables.payment_methods, _buckets(self._spark))

    def _bucketed(self, table: DataFrame, name: str) -> DataFrame:
        return write_bucketed(table, f"{self._root}/{name}", None, LAKE_LAYOUT[name][1], _buckets(self._spark))

    def _lines(self) -> DataFrame:
        items = clean.clean_order_items(self._tables.bronze.order_items, _buckets(self._spark))
        return self._bucketed(silver.silver_lines(items, self._dealt_orders, self._tables.products), "lines")

    def _orders(self) -> DataFrame:
        # the sums come from the written lines, so items are cleaned and priced once; an item without an order belongs to none here either
        facts = self._bucketed(silver.order_facts(self._dealt_orders, silver.order_sums(self.lines)), "orders")
        return silver.looked_up_orders(facts, self.lines, self._tables.customers)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name in LAKE_LAYOUT:
            frame = self._lines() if name == "lines" else self._orders()
        else:
            table, path = getattr(self._tables, name), f"{self._root}/{name}"
            write_lake(table, path)
            frame = self._spark.read.schema(table.schema).parquet(path)
        setattr(self, name, frame)
        return frame


class StagedOrders(Staged):
    """The same for queries on customers' histories, which use no line as such: orders are written once, with the revenue of each
    of their categories in them and without columns that no history has; there are no lines."""

    def _lines(self) -> DataFrame:
        raise AttributeError("orders are staged without lines")

    def _orders(self) -> DataFrame:
        raw, parts, path = self._tables.bronze, _buckets(self._spark), f"{self._root}/orders"
        valid = clean.leading(clean.valid_lines(raw.order_items), clean.ITEM_KEY, ["product_id", "quantity", "list_price", "unit_price"])
        items = clean.dedupe_dealt(silver.with_category(valid, self._tables.products), clean.ITEM_KEY, "order_id", parts)
        header = clean.leading(raw.orders, ["order_id"], ["customer_id", "order_ts", "status", "payment_method", "device"])
        orders = clean.clean_orders(header, self._tables.payment_methods, parts)
        table = silver.order_purchases(orders, items.filter("in_catalogue"))
        write_lake(table, path)
        return self._spark.read.schema(table.schema).parquet(path)

    @property
    def purchases(self) -> DataFrame:
        return silver.purchases(self.orders)


def write_silver(spark: SparkSession, tables: Silver, root: str) -> Lake:
    """Writes all silver tables and returns them as read back.  Facts are looked up in raw rows and dealt by order once, into the
    buckets they are written in; items are cleaned and priced once.  One table is written after the other, and the shuffle files
    of each go before the next."""
    buckets = _buckets(spark)
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{root}/layout")

    def fact(name: str, table: DataFrame) -> DataFrame:
        with freed_shuffles(spark):
            return write_bucketed(table, f"{root}/{name}", *LAKE_LAYOUT[name], buckets, LAKE_COMPRESSION)

    headers = clean.clean_orders(tables.bronze.orders, tables.payment_methods, buckets)
    lines = fact("lines", silver.with_header(dealt_priced(tables, buckets), headers).select(*tables.lines.columns).withColumn(
        "order_month", month_key("order_date")))
    # the sums come from the written lines; an item without an order, which they lack, belongs to none here either
    facts = silver.order_facts(dealt_orders(tables, buckets), silver.order_totals(lines))
    fact("orders", facts.select(*tables.orders.columns))
    for name in ("customers", "products", "events", "sessions"):
        with freed_shuffles(spark):
            table = getattr(tables, name) if name != "sessions" else tables.sessions_of(spark.read.parquet(f"{root}/events"))
            write_lake(table, f"{root}/{name}", compression=LAKE_COMPRESSION)
    return Lake(spark, root)
