"""Parameterised queries over gold and silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.calendar import month_key, period_start
from tradewind.functions.exprs import money_sum, pct, ratio, rnd
from tradewind.operators import distinct
from tradewind.operators.ranking import top_n, unpivot, upper_medians
from tradewind.operators.segment import segment_actions

# Permitted sort columns and the column names of the exported campaign list.
PRODUCT_SORTS = {"revenue", "units", "avg_rating", "return_rate", "views", "view_to_buy_pct", "profit", "list_price"}
CHURN_SORTS = {"clv_12m", "churn_probability", "total_spent", "recency_days"}
WINBACK_COLUMNS = {
    "customer_id": "customer_id", "full_name": "name", "email": "email", "city": "city", "segment": "segment",
    "orders": "orders", "total_spent": "total_spent", "recency_days": "days_since_last_order",
    "churn_probability": "churn_probability", "churn_risk": "risk", "clv_12m": "predicted_12m_value",
    "favourite_category": "favourite_category",
}


def between(df: DataFrame, start: Column | str | None, end: Column | str | None, date: str = "date") -> DataFrame:
    """Inclusive date bounds; either may be open."""
    if start is not None:
        df = df.filter(F.col(date) >= (F.lit(start).cast("date") if isinstance(start, str) else start))
    if end is not None:
        df = df.filter(F.col(date) <= (F.lit(end).cast("date") if isinstance(end, str) else end))
    return df


def sales_trend(
    daily: DataFrame, granularity: str = "day", start=None, end=None, category: str | None = None, buyers: DataFrame | None = None,
) -> DataFrame:
    """Periods of daily (or day x category) sales, plus one totals row (`is_total`).

    `buyers`, the sets of customer ids by date (`distinct.id_words`), gives `customers`: distinct in each period and in
    all, which daily counts can't be added up to."""
    days = between(daily, start, end)
    if category is not None:
        days = days.filter(F.col("category") == category)
    keyed = days.withColumn("period", period_start(granularity, "date"))
    rolled = keyed.rollup("period").agg(
        F.grouping("period").cast("int").alias("is_total"), F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"), F.sum("units").alias("units"), F.sum("profit").alias("profit"),
        F.countDistinct("date").alias("days"))
    trend = rolled.select(
        "period", "is_total", rnd("revenue", 2).alias("revenue"), "orders", "units", rnd("profit", 2).alias("profit"),
        "days", F.coalesce(rnd(ratio("revenue", "orders"), 2), F.lit(0.0)).alias("aov"))
    if buyers is None:
        return trend
    sets = between(buyers, start, end)
    if category is not None:
        sets = sets.filter(F.col("category") == category)
    in_period = distinct.merged(sets, [period_start(granularity, "date").alias("_period")])
    counts = distinct.set_sizes(in_period, ["_period"], "_n")
    everyone = distinct.merged(in_period, []).agg(F.sum(F.bit_count("bits"))).scalar()
    return trend.join(counts, F.col("period") == F.col("_period"), "left").withColumn(
        "customers", F.coalesce(F.when(F.col("is_total") == 1, everyone).otherwise(F.col("_n")), F.lit(0)).cast("bigint")).drop("_period", "_n")


def categories_in_period(daily_category: DataFrame, by_category: DataFrame, start=None, end=None) -> DataFrame:
    """Live sums of a period with margin and share, and the all-time rates of each category."""
    live = between(daily_category, start, end).groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.sum("orders").alias("orders"),
        F.sum("profit").alias("profit"))
    total = between(daily_category, start, end).agg(F.sum("revenue").alias("t")).scalar()
    return live.join(
        by_category.select("category", "return_rate", "avg_rating", "avg_discount_pct"), "category", "left",
    ).select(
        "category", rnd("revenue", 2).alias("revenue"), "units", "orders", rnd("profit", 2).alias("profit"),
        F.coalesce(pct("profit", "revenue"), F.lit(0.0)).alias("margin_pct"), pct("revenue", total).alias("share_pct"),
        "return_rate", "avg_rating", "avg_discount_pct")


def _ordered(column: str, descending: bool) -> Column:
    return F.desc_nulls_last(column) if descending else F.asc_nulls_first(column)


def search_products(
    stats: DataFrame, category: str | None = None, text: str | None = None, sort: str = "revenue",
    descending: bool = True, limit: int = 25, skip: int = 0,
) -> DataFrame:
    """One page of matching products, each row with the total number of matches."""
    found = stats.filter(F.col("category") == category) if category else stats
    if text:
        found = found.filter(F.contains(F.lower("product_name"), F.lit(text.lower())))
    total = found.agg(F.count("*").alias("n")).scalar()
    page = found.orderBy(_ordered(sort if sort in PRODUCT_SORTS else "revenue", descending), "product_id")
    return page.offset(skip).limit(limit).withColumn("total", total)


def product_details(stats: DataFrame, similar: DataFrame, together: DataFrame) -> DataFrame:
    """Products with their similar[] and bought_together[] lists resolved to catalogue attributes.

    Both lists are short (8 and 5), given as rows (product_id, other, rank, ...).
    """
    info = stats.select(
        F.col("product_id").alias("other"), "product_name", "category", "sub_category", "list_price", "avg_rating")

    def nested(pairs, extra, name):
        item = F.struct("rank", "other", *extra, "product_name", "category", "sub_category", "list_price", "avg_rating")
        return pairs.join(info, "other").groupBy("product_id").agg(F.array_sort(F.collect_list(item)).alias(name))

    out = stats.join(nested(similar, ["score"], "similar"), "product_id", "left")
    out = out.join(nested(together, ["confidence", "lift"], "bought_together"), "product_id", "left")
    return out


def churn_customers(
    profiles: DataFrame, risk: str | None = "High", segment: str | None = None, sort: str = "clv_12m", limit: int | None = None,
) -> DataFrame:
    found = profiles.filter(F.col("churn_probability").isNotNull())
    if risk and risk != "All":
        found = found.filter(F.col("churn_risk") == risk)
    if segment:
        found = found.filter(F.col("segment") == segment)
    by = sort if sort in CHURN_SORTS else "clv_12m"
    ordered = found.orderBy(F.desc_nulls_last(by), "customer_id")
    return ordered if limit is None else ordered.limit(limit)


def winback_export(profiles: DataFrame, risk: str = "High", segment: str | None = None, limit: int | None = None) -> DataFrame:
    """The campaign list under its 12 published column names; write it with sinks.write_csv."""
    rows = churn_customers(profiles, risk, segment, "clv_12m", limit)
    return rows.select(*[F.col(c).alias(n) for c, n in WINBACK_COLUMNS.items()])


def feature_medians(features: DataFrame, columns: list[str]) -> DataFrame:
    """Upper median of every feature over all rows, by a distributed sort of the distinct values."""
    return upper_medians(unpivot(features, ["customer_id"], columns), ["feature"], "value")


def recent_purchases(lines: DataFrame, orders: int = 15, products: int = 8) -> DataFrame:
    """Per customer: the products of the last `orders` non-cancelled orders, newest first, at most
    `products`.  (customer_id, product_id, product_name, category, last_ts, rank)."""
    kept = lines.filter(F.col("status") != "Cancelled")
    headers = kept.groupBy("customer_id", "order_id").agg(F.max("order_ts").alias("order_ts"))
    recent = top_n(headers, ["customer_id"], [F.desc("order_ts"), F.desc("order_id")], orders, "_o")
    touched = kept.join(recent.select("customer_id", "order_id"), ["customer_id", "order_id"]).groupBy(
        "customer_id", "product_id").agg(
        F.min("product_name").alias("product_name"), F.min("category").alias("category"),
        F.max("order_ts").alias("last_ts"))
    return top_n(touched, ["customer_id"], [F.desc("last_ts"), F.col("product_id")], products)


def search_customers(profiles: DataFrame, text: str, limit: int = 10) -> DataFrame:
    """Id prefix or literal text in the name, by spend; an empty text lists the top Champions."""
    q = text.strip()
    if not q:
        found = profiles.filter(F.col("segment") == "Champions")
    else:
        found = profiles.filter(
            F.startswith(F.col("customer_id").cast("string"), F.lit(q.upper()))
            | F.contains(F.col("search_name"), F.lit(q.lower())))
    return found.orderBy(F.desc("total_spent"), "customer_id").limit(limit)


def customer_monthly_spend(orders: DataFrame) -> DataFrame:
    return orders.filter("is_revenue").groupBy("customer_id", month_key("order_date").alias("month")).agg(
        money_sum("net_amount").alias("revenue"), F.count("*").alias("orders"))


def customer_category_spend(lines: DataFrame) -> DataFrame:
    """All non-cancelled lines, returns included."""
    return lines.filter(F.col("status") != "Cancelled").groupBy("customer_id", "category").agg(
        money_sum("revenue").alias("revenue"))


def customer_recent_orders(orders: DataFrame, n: int = 12) -> DataFrame:
    return top_n(orders, ["customer_id"], [F.desc("order_ts"), F.desc("order_id")], n)


def customer_actions(profiles: DataFrame) -> DataFrame:
    """Profiles with the recommended action of their segment (a fixed table of 11 rows)."""
    return profiles.join(F.broadcast(segment_actions(profiles.sparkSession)), "segment", "left")


def meta(daily: DataFrame, by_category: DataFrame, as_of: Column) -> DataFrame:
    """Date range, as-of day and the sorted category names (one name per category)."""
    categories = by_category.agg(F.array_sort(F.collect_set("category")).alias("c")).scalar()
    return daily.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date")).select(
        as_of.alias("as_of"), "min_date", "max_date", F.concat_ws(",", categories).alias("categories"))


def with_names(meta_row: DataFrame, segments: DataFrame, series: DataFrame) -> DataFrame:
    """The meta row with the names of all segments and forecast series, sorted (both are short)."""
    listed = lambda df, c: F.concat_ws(",", df.agg(F.array_sort(F.collect_set(c)).alias("x")).scalar())
    return meta_row.withColumns({"segments": listed(segments, "segment"), "forecast_series": listed(series, "series")})


def overview_rows(parts: dict[str, tuple[DataFrame, str | None, list[str]]]) -> DataFrame:
    """The landing page in long form: (part, key, measure, value).  A part is a short frame, its key column (None: one row)
    and its measures; missing values have no row."""
    out = None
    for part, (df, key, measures) in parts.items():
        named = df.select(F.lit(part).alias("part"), (F.col(key) if key else F.lit("all")).cast("string").alias("key"), *measures)
        rows = unpivot(named, ["part", "key"], measures, "measure").filter(F.col("value").isNotNull())
        out = rows if out is None else out.unionByName(rows)
    return out


def overview(
    kpi: DataFrame, monthly: DataFrame, stats: DataFrame, segments: DataFrame, anomalies: DataFrame,
) -> DataFrame:
    """The landing page as one row: KPIs, months, top 6 products, segments, last 5 unusual days.
    Every nested list is short (months, segments, 6 products, 5 days)."""

    def nested(df: DataFrame) -> Column:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias("x")).scalar()

    top = stats.orderBy(F.desc("revenue"), "product_id").limit(6).select(
        (-F.col("revenue")).alias("order_key"), "product_id", "product_name", "revenue")
    days = anomalies.filter(F.col("type") == "daily_revenue").orderBy(F.desc("date")).limit(5)
    return kpi.select(
        F.struct(*kpi.columns).alias("kpis"), nested(monthly).alias("monthly"),
        nested(top).alias("top_products"), nested(segments.select("segment", "customers", "revenue")).alias("segments"),
        nested(days.select("date", "actual", "expected", "severity")).alias("anomalies"))
