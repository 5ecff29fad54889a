"""Registered queries over cleaning, silver, sales and behaviour operators, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.functions.exprs import dbl
from tradewind.operators import behaviour, clean, sales
from tradewind.operators import silver as sv
from tradewind.plans.oracle_base import big, growth, pct, ratio, rnd, sql
from tradewind.plans.oracle_base import dbl as sdbl
from tradewind.plans.sample import Sample
from tradewind.sources import roles

MONEY_LINE = ["revenue", "gross_value", "cost", "profit", "discount_amount"]
MONEY_ORDER = ["gross_value", "net_amount", "discount_amount", "profit"]


# queries that read the silver tables several times
STAGED = {"kpi_document"}
# queries that read orders and lines once each, by order
DEALT = {"order_documents", "order_documents_flat"}


def _edge(df, cols):
    """Decimals leave as doubles."""
    return df.withColumns({c: dbl(c) for c in cols})


def _funnel(s: Sample):
    return behaviour.funnel_base(s.sessions)


QUERIES = {
    # ------------------------------------------------------------------ cleaning
    "clean_blank_to_null": lambda s: clean.blank_to_null(s.bronze.orders, ["coupon_code"]).select(
        "order_id", "coupon_code"),
    "clean_canonicalise": lambda s: clean.canonicalise(
        clean.blank_to_null(s.bronze.customers, ["city"]), "city", roles.city_vocabulary(s.spark, s.sf_dir)
    ).select("customer_id", "city"),
    "clean_payment_method": lambda s: clean.clean_orders(s.bronze.orders, roles.PAYMENT_VOCABULARY).select(
        "order_id", "payment_method", "status"),
    "clean_fill_defaults": lambda s: clean.fill_defaults(
        clean.blank_to_null(s.bronze.customers, ["city"]), {"city": "Unknown", "age": 30}
    ).groupBy("city").agg(F.count("*").alias("customers")).filter("city = 'Unknown'"),
    "clean_dedupe_lines": lambda s: _edge(
        clean.dedupe(s.bronze.order_items, ["order_id", "line_no"]), ["list_price", "unit_price", "discount_pct"]),
    "clean_valid_lines": lambda s: _edge(
        clean.valid_lines(s.bronze.order_items), ["list_price", "unit_price", "discount_pct"]),
    "clean_valid_events": lambda s: s.events.select(
        "event_id", "customer_id", "event_type", "product_id", "device", "traffic_source"),
    "customer_names": lambda s: s.customers.select(
        "customer_id", "full_name", F.lower("full_name").alias("search_name")),
    "product_margin": lambda s: s.products.select("product_id", "margin_pct"),
    "dq_report": lambda s: clean.dq_report(s.bronze, roles.PAYMENT_VOCABULARY),
    # ------------------------------------------------------------------ silver
    "silver_lines": lambda s: _edge(s.lines, MONEY_LINE).select(
        "order_id", "line_no", "product_id", "customer_id", "category", "sub_category", "quantity", *MONEY_LINE,
        "rating", "status", "device", "order_date", "is_revenue"),
    "silver_order_totals": lambda s: _edge(sv.order_totals(
        sv.priced_items(clean.clean_order_items(s.bronze.order_items), s.products)), MONEY_ORDER
    ).withColumn("categories", F.concat_ws(",", "categories")),
    "silver_orders": lambda s: _edge(s.orders, MONEY_ORDER).select(
        "order_id", "customer_id", "order_date", "order_month", "status", "payment_method", "device", "coupon_code",
        "coupon_used", "is_revenue", "items_count", "units", *MONEY_ORDER, "city", "state", "region", "city_tier"),
    "sessions": lambda s: s.sessions.select(
        "session_id", "customer_id", F.unix_micros("start_time").alias("start_us"),
        F.unix_micros("end_time").alias("end_us"), "events", "product_views", "has_view", "has_cart", "has_checkout",
        "has_purchase", "device", "traffic_source", "duration_sec", "is_bounce", "session_date"),
    "session_rollup": lambda s: sv.session_rollup(s.events).select(
        "session_id", "customer_id", "events", "product_views", "has_cart", "has_checkout", "has_purchase", "device",
        "traffic_source", "duration_sec", "is_bounce"),
    "as_of_date": lambda s: sv.as_of_date(s.orders),
    # ------------------------------------------------------------------ sales
    "kpis": lambda s: sales.kpis(s.orders, s.lines, s.customers),
    "session_kpis": lambda s: sales.session_kpis(s.sessions),
    "kpi_growth": lambda s: sales.kpi_growth(s.orders, s.silver.as_of),
    "status_breakdown": lambda s: sales.status_breakdown(s.orders),
    "kpi_document": lambda s: sales.kpi_document(s.orders, s.lines, s.customers, s.sessions, s.silver.as_of),
    "sales_daily": lambda s: sales.sales_daily(s.orders),
    "sales_daily_category": lambda s: sales.sales_daily_category(s.lines),
    "sales_monthly": lambda s: sales.sales_monthly(s.orders),
    "sales_by_category": lambda s: sales.sales_by_category(s.lines, s.orders),
    "sales_by_subcategory": lambda s: sales.sales_by_subcategory(s.lines),
    "sales_by_city": lambda s: sales.sales_by_city(s.orders, s.table("nation").select(
        F.col("n_name").alias("city"), (F.col("n_nationkey") * 1.5).alias("lat"),
        (F.col("n_nationkey") * 2.5).alias("lon"))),
    "sales_by_state": lambda s: sales.sales_by_state(s.orders),
    "sales_by_dimension": lambda s: sales.sales_by_dimension(s.orders),
    "sales_by_channel": lambda s: sales.sales_by_channel(s.orders, s.customers),
    "sales_dimensions": lambda s: sales.sales_dimensions(s.orders, s.customers),
    "sales_heatmap": lambda s: sales.sales_heatmap(s.events.select(
        "event_time", F.lit(True).alias("is_revenue"), F.lit(1).cast("decimal(18,2)").alias("net_amount")),
        "event_time"),
    "sales_heatmap_orders": lambda s: sales.sales_heatmap(s.orders),
    "campaign_uplift": lambda s: sales.campaign_uplift(s.orders),
    "product_stats": lambda s: sales.product_stats(s.products, s.lines, s.events).select(
        "product_id", "category", "revenue", "units", "orders", "buyers", "avg_rating", "ratings", "return_rate",
        "profit", "views", "carts", "wishlists", "view_to_buy_pct", "cart_to_buy_pct", "category_rank"),
    "top_products": lambda s: sales.top_products(sales.product_stats(s.products, s.lines, s.events)).select(
        "product_id", "product_name", "revenue", "units", "category_rank"),
    # ------------------------------------------------------------------ behaviour
    "funnel_overall": lambda s: behaviour.funnel_steps(_funnel(s).filter("dimension = 'all'")),
    "funnel_by_dimension": lambda s: behaviour.funnel_steps(_funnel(s)),
    "funnel_rates": lambda s: behaviour.funnel_rates(_funnel(s)),
    "funnel_documents": lambda s: behaviour.funnel_documents(_funnel(s)),
    "traffic_hourly": lambda s: behaviour.traffic_hourly(s.sessions),
    "traffic_monthly": lambda s: behaviour.traffic_monthly(s.sessions),
    "event_counts": lambda s: behaviour.event_counts(s.events),
    "cohort_retention": lambda s: behaviour.cohort_retention(s.orders),
    "cohort_documents": lambda s: behaviour.cohort_documents(behaviour.cohort_retention(s.orders)),
    "order_documents": lambda s: behaviour.order_documents(s.orders, s.lines),
    "order_documents_flat": lambda s: _edge(behaviour.order_documents_flat(
        behaviour.order_documents(s.orders, s.lines)), ["list_price", "unit_price", "discount_pct", "revenue"]),
    "customer_profiles": lambda s: behaviour.customer_profiles(
        s.orders, s.lines, s.sessions, s.customers, s.silver.as_of),
    "preferred_value": lambda s: behaviour.preferred_value(
        s.orders, "customer_id", "device", F.count("*"), "preferred_device"),
}

_D = {c: f"{sdbl(c)} AS {c}" for c in [*MONEY_LINE, *MONEY_ORDER, "list_price", "unit_price", "discount_pct"]}
_ITEM_EDGE = f"{_D['list_price']}, {_D['unit_price']}, {_D['discount_pct']}"


def _money(cols):
    return ", ".join(_D[c] for c in cols)


def _sum(x):
    return sdbl(f"sum({x})")


def _cnt(cond):
    return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"


_SALE_DAYS = """sale_days AS (
  SELECT date, arg_max(event, pos) AS event, arg_max(sale_day, pos) AS sale_day FROM (
    SELECT CAST(make_date(y, m, dd) + n AS DATE) AS date, y, pos, event, n AS sale_day
    FROM sale_events, (SELECT unnest(range(0, 31))::INTEGER AS n), (SELECT unnest(range(1990, 2031))::INTEGER AS y)
    WHERE n < len) WHERE year(date) = y GROUP BY date)"""

_PRODUCT_STATS = f"""psales AS (
  SELECT product_id, {_sum('CASE WHEN is_revenue THEN revenue END')} AS revenue,
         {big('sum(CASE WHEN is_revenue THEN quantity END)')} AS units, count(DISTINCT order_id) AS orders,
         count(DISTINCT customer_id) AS buyers, {rnd('avg(rating)', 2)} AS avg_rating, count(rating) AS ratings,
         {pct(_cnt("status = 'Returned'"), 'count(*)')} AS return_rate,
         {_sum('CASE WHEN is_revenue THEN profit END')} AS profit
  FROM lines GROUP BY product_id),
pviews AS (
  SELECT product_id, {big(_cnt("event_type = 'product_view'"))} AS views,
         {big(_cnt("event_type = 'add_to_cart'"))} AS carts, {big(_cnt("event_type = 'add_to_wishlist'"))} AS wishlists
  FROM clicks WHERE product_id IS NOT NULL GROUP BY product_id),
pstats0 AS (
  SELECT p.product_id, p.product_name, p.category, p.sub_category, p.brand, p.list_price,
         coalesce(s.revenue, 0) AS revenue, coalesce(s.units, 0) AS units, coalesce(s.orders, 0) AS orders,
         coalesce(s.buyers, 0) AS buyers, s.avg_rating, s.ratings, s.return_rate, coalesce(s.profit, 0) AS profit,
         coalesce(v.views, 0) AS views, coalesce(v.carts, 0) AS carts, coalesce(v.wishlists, 0) AS wishlists
  FROM products p LEFT JOIN psales s USING (product_id) LEFT JOIN pviews v USING (product_id)),
pstats AS (
  SELECT *, {pct('orders', 'views')} AS view_to_buy_pct, {pct('orders', 'carts')} AS cart_to_buy_pct,
         CAST(rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS INTEGER) AS category_rank
  FROM pstats0)"""

_STEPS = [("Sessions", "n"), ("Viewed Product", "v"), ("Added to Cart", "c"), ("Checkout", "k"), ("Purchased", "p")]
_FUNNEL = """fbase AS (
  SELECT CASE WHEN grouping(device) = 0 THEN 'device' WHEN grouping(traffic_source) = 0 THEN 'traffic_source'
              ELSE 'all' END AS dimension,
         CASE WHEN grouping(device) = 0 THEN device WHEN grouping(traffic_source) = 0 THEN traffic_source
              ELSE 'All' END AS value,
         count(*) AS n, sum(has_view)::BIGINT AS v, sum(has_cart)::BIGINT AS c, sum(has_checkout)::BIGINT AS k,
         sum(has_purchase)::BIGINT AS p, sum(duration_sec) AS dur, sum(events) AS ev, sum(is_bounce) AS b
  FROM sessions GROUP BY GROUPING SETS ((), (device), (traffic_source)))"""
_FUNNEL_STEPS = " UNION ALL ".join(
    f"""SELECT dimension, value, {i + 1} AS step_no, '{label}' AS step, {c} AS sessions,
        {pct(c, 'greatest(n, 1)')} AS pct_of_sessions,
        coalesce({pct(c, _STEPS[max(i - 1, 0)][1])}, 0.0) AS step_conversion FROM fbase"""
    for i, (label, c) in enumerate(_STEPS))

_COHORTS = f"""cohort_rows AS (
  WITH act AS (SELECT customer_id, date_trunc('month', order_date)::DATE AS m FROM rev GROUP BY ALL),
  aged AS (SELECT strftime(min(m) OVER (PARTITION BY customer_id), '%Y-%m') AS cohort,
                  CAST(datediff('month', min(m) OVER (PARTITION BY customer_id), m) AS INTEGER) AS month FROM act),
  n AS (SELECT cohort, month, count(*) AS customers FROM aged GROUP BY ALL)
  SELECT n.cohort, n.month, n.customers, z.customers AS size, {pct('n.customers', 'z.customers')} AS pct
  FROM n JOIN n z ON n.cohort = z.cohort AND z.month = 0)"""

PROFILES = f"""profiles AS (
  WITH h AS (
    SELECT customer_id, count(*) AS orders_placed, {big(_cnt("status = 'Cancelled'"))} AS cancelled,
           {big(_cnt("status = 'Returned'"))} AS returned, min(order_date) AS first_order, max(order_date) AS last_order
    FROM s_orders GROUP BY 1),
  m AS (
    SELECT customer_id, count(*) AS orders, {_sum('net_amount')} AS total_spent,
           {rnd(ratio('sum(net_amount)', 'count(*)'), 2)} AS aov, {_sum('discount_amount')} AS total_discount
    FROM rev GROUP BY 1),
  f AS (
    SELECT customer_id, category AS favourite_category FROM (
      SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY sum(revenue) DESC, category) AS rn
      FROM rlines GROUP BY 1, 2) WHERE rn = 1),
  d AS (
    SELECT customer_id, device AS preferred_device FROM (
      SELECT customer_id, device, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, device) AS rn
      FROM s_orders GROUP BY 1, 2) WHERE rn = 1),
  y AS (
    SELECT customer_id, payment_method AS preferred_payment FROM (
      SELECT customer_id, payment_method,
             row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, payment_method) AS rn
      FROM s_orders GROUP BY 1, 2) WHERE rn = 1),
  v AS (
    SELECT customer_id, count(*) AS sessions, max(session_date) AS last_seen,
           {rnd('avg(duration_sec)', 1)} AS avg_session_sec, {big('sum(has_cart)')} AS cart_sessions,
           {big('sum(has_purchase)')} AS purchase_sessions
    FROM sessions GROUP BY 1)
  SELECT c.customer_id, c.full_name, c.email, c.gender, c.age, c.city, c.state, c.region, c.city_tier, c.signup_date,
         c.acquisition_channel, coalesce(h.orders_placed, 0) AS orders_placed, coalesce(h.cancelled, 0) AS cancelled,
         coalesce(h.returned, 0) AS returned, h.first_order, h.last_order, coalesce(m.orders, 0) AS orders,
         coalesce(m.total_spent, 0) AS total_spent, m.aov, m.total_discount, f.favourite_category, d.preferred_device,
         y.preferred_payment, coalesce(v.sessions, 0) AS sessions, v.last_seen, v.avg_session_sec,
         coalesce(v.cart_sessions, 0) AS cart_sessions, coalesce(v.purchase_sessions, 0) AS purchase_sessions,
         CAST(datediff('day', h.last_order, (SELECT d FROM ref_day)) AS INTEGER) AS recency_days,
         CASE WHEN coalesce(m.orders, 0) = 0 THEN 'Prospects' END AS segment, lower(c.full_name) AS search_name
  FROM customers c LEFT JOIN h USING (customer_id) LEFT JOIN m USING (customer_id) LEFT JOIN f USING (customer_id)
  LEFT JOIN d USING (customer_id) LEFT JOIN y USING (customer_id) LEFT JOIN v USING (customer_id))"""


def _by_dimension(dim: str) -> str:
    return f"""SELECT '{dim}' AS dimension, CAST({dim} AS VARCHAR) AS value,
        {_sum('CASE WHEN is_revenue THEN net_amount END')} AS revenue, count(*) AS orders,
        {pct(_cnt("status = 'Cancelled'"), 'count(*)')} AS cancel_rate,
        {pct(_cnt("status = 'Returned'"), 'count(*)')} AS return_rate,
        {rnd(ratio('sum(net_amount)', 'count(*)'), 2)} AS aov FROM s_orders GROUP BY {dim}"""


_DIMENSIONS = " UNION ALL ".join(_by_dimension(d) for d in sales.ORDER_DIMENSIONS)
_CHANNEL = f"""SELECT 'acquisition_channel' AS dimension, acquisition_channel AS value, {_sum('net_amount')} AS revenue,
    count(*) AS orders, count(DISTINCT customer_id) AS customers, {rnd(ratio('sum(net_amount)', 'count(*)'), 2)} AS aov
    FROM rev JOIN customers USING (customer_id) GROUP BY acquisition_channel"""


def _dq(table: str, source: str, **metrics: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{m}' AS metric, {big(x)} AS value FROM {source}" for m, x in metrics.items())


_EVENT_OK = """lower(event_type) IN ('page_view','product_view','add_to_cart','remove_from_cart','add_to_wishlist',
 'checkout','purchase') AND NOT (lower(event_type) = 'product_view' AND product_id IS NULL)"""
_DQ = " UNION ALL ".join([
    _dq("customers", "b_customers", raw="count(*)", clean="count(DISTINCT customer_id)",
        duplicates_removed="count(*) - count(DISTINCT customer_id)", missing_city_filled=_cnt("trim(city) = ''")),
    _dq("products", "b_products", raw="count(*)", clean=_cnt("list_price > 0"),
        invalid_removed=f"count(*) - {_cnt('list_price > 0')}"),
    _dq("orders", "b_orders", raw="count(*)", clean="count(DISTINCT order_id)",
        duplicates_removed="count(*) - count(DISTINCT order_id)",
        payment_values_standardised=_cnt("payment_method <> upper(trim(payment_method))")),
    _dq("order_items", "b_items", raw="count(*)",
        clean="count(DISTINCT CASE WHEN quantity > 0 AND unit_price > 0 THEN (order_id, line_no) END)",
        invalid_quantity_removed=_cnt("quantity <= 0")),
    _dq("events", "b_events", raw="count(*)", clean=_cnt(_EVENT_OK),
        duplicates_removed="count(*) - count(DISTINCT event_id)",
        event_type_case_fixed=_cnt("event_type <> lower(event_type)"),
        invalid_removed=f"count(*) - {_cnt(_EVENT_OK)}"),
])

_SESSION_COLS = """events, product_views, has_view, has_cart, has_checkout, has_purchase, device, traffic_source,
  duration_sec, is_bounce, session_date"""


def _growth_part(name: str, lo: int, hi: int) -> str:
    cond = f"age >= {lo} AND age < {hi}"
    return f"""coalesce({_sum(f'CASE WHEN {cond} THEN net_amount END')}, 0) AS revenue_{name},
      {big(_cnt(cond))} AS orders_{name}, count(DISTINCT CASE WHEN {cond} THEN customer_id END) AS customers_{name}"""


ORACLE = {
    "clean_blank_to_null": sql("SELECT order_id, nullif(trim(coupon_code), '') AS coupon_code FROM b_orders"),
    "clean_canonicalise": sql("SELECT customer_id, nullif(city, 'Unknown') AS city FROM customers"),
    "clean_payment_method": sql("SELECT order_id, payment_method, status FROM orders_clean"),
    "clean_fill_defaults": sql("SELECT 'Unknown' AS city, count(*) AS customers FROM customers WHERE city = 'Unknown'"),
    "clean_dedupe_lines": sql(f"""SELECT order_id, line_no, product_id, quantity, {_ITEM_EDGE}, rating FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY product_id NULLS FIRST,
          quantity NULLS FIRST, list_price NULLS FIRST, unit_price NULLS FIRST, discount_pct NULLS FIRST,
          rating NULLS FIRST) AS rn FROM b_items) WHERE rn = 1"""),
    "clean_valid_lines": sql(f"""SELECT order_id, line_no, product_id, quantity, {_ITEM_EDGE}, rating
        FROM b_items WHERE quantity > 0 AND unit_price > 0"""),
    "clean_valid_events": sql("SELECT event_id, customer_id, event_type, product_id, device, traffic_source FROM clicks"),
    "customer_names": sql("SELECT customer_id, full_name, lower(full_name) AS search_name FROM customers"),
    "product_margin": sql("SELECT product_id, margin_pct FROM products"),
    "dq_report": sql(_DQ),
    "silver_lines": sql(f"""SELECT order_id, line_no, product_id, customer_id, category, sub_category, quantity,
        {_money(MONEY_LINE)}, rating, status, device, order_date, is_revenue FROM lines"""),
    "silver_order_totals": sql(f"""SELECT order_id, items_count, {big('units')} AS units, {_money(MONEY_ORDER)},
        array_to_string(categories, ',') AS categories FROM totals"""),
    "silver_orders": sql(f"""SELECT order_id, customer_id, order_date, order_month, status, payment_method, device,
        coupon_code, coupon_used, is_revenue, items_count, {big('units')} AS units, {_money(MONEY_ORDER)}, city, state,
        region, city_tier FROM s_orders"""),
    "sessions": sql(f"""SELECT session_id, customer_id, epoch_us(start_time) AS start_us, epoch_us(end_time) AS end_us,
        {_SESSION_COLS} FROM sessions"""),
    "session_rollup": sql(f"""SELECT session_id, arg_min(customer_id, (event_time, event_id)) AS customer_id,
        count(*) AS events, {big(_cnt("event_type = 'product_view'"))} AS product_views,
        max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS has_cart,
        max(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) AS has_checkout,
        max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase,
        arg_min(device, (event_time, event_id)) AS device,
        arg_min(traffic_source, (event_time, event_id)) AS traffic_source,
        {big("epoch(date_trunc('second', max(event_time))) - epoch(date_trunc('second', min(event_time)))")} AS duration_sec,
        CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS is_bounce FROM clicks GROUP BY session_id"""),
    "as_of_date": sql("SELECT d AS as_of FROM ref_day"),
    "kpis": sql(f"""SELECT (SELECT d FROM ref_day) AS as_of, r.revenue, r.orders, a.placed AS orders_placed, r.customers,
        (SELECT count(*) FROM customers) AS total_customers, r.units, r.profit, {pct('r.profit', 'r.revenue')} AS margin_pct,
        r.discount_given, {rnd(ratio('r.revenue', 'r.orders'), 2)} AS aov,
        {pct('(SELECT count(*) FROM (SELECT customer_id FROM rev GROUP BY 1 HAVING count(*) > 1))', 'r.customers')}
          AS repeat_customer_rate,
        {pct('a.cancelled', 'a.placed')} AS cancel_rate, {pct('a.returned', 'a.placed')} AS return_rate,
        {rnd('(SELECT avg(rating) FROM lines)', 2)} AS avg_rating
        FROM (SELECT {_sum('net_amount')} AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS customers,
              {big('sum(units)')} AS units, {_sum('profit')} AS profit, {_sum('discount_amount')} AS discount_given FROM rev) r,
             (SELECT count(*) AS placed, {_cnt("status = 'Cancelled'")} AS cancelled,
              {_cnt("status = 'Returned'")} AS returned FROM s_orders) a"""),
    "session_kpis": sql(f"""SELECT count(*) AS sessions, {pct('sum(has_purchase)', 'count(*)')} AS conversion_rate,
        {pct(_cnt('has_cart = 1 AND has_purchase = 0'), 'sum(has_cart)')} AS cart_abandonment_rate,
        {rnd('avg(duration_sec)', 1)} AS avg_session_sec, {rnd('avg(is_bounce) * 100', 2)} AS bounce_rate FROM sessions"""),
    "kpi_growth": sql(f"""SELECT *, {growth('revenue_last', 'revenue_prev')} AS revenue_growth,
        {growth('orders_last', 'orders_prev')} AS orders_growth, {growth('customers_last', 'customers_prev')} AS customers_growth
        FROM (SELECT {_growth_part('last', 0, 30)}, {_growth_part('prev', 30, 60)}
              FROM (SELECT *, datediff('day', order_date, (SELECT d FROM ref_day)) AS age FROM rev))"""),
    "status_breakdown": sql("SELECT status, count(*) AS orders FROM s_orders GROUP BY status"),
    "sales_daily": sql(f"""SELECT *, {rnd(ratio('revenue', 'orders'), 2)} AS aov FROM (
        SELECT order_date AS date, {_sum('net_amount')} AS revenue, count(*) AS orders,
        count(DISTINCT customer_id) AS customers, {big('sum(units)')} AS units, {_sum('profit')} AS profit
        FROM rev GROUP BY order_date)"""),
    "sales_daily_category": sql(f"""SELECT order_date AS date, category, {_sum('revenue')} AS revenue,
        count(DISTINCT order_id) AS orders, {big('sum(quantity)')} AS units, {_sum('profit')} AS profit
        FROM rlines GROUP BY order_date, category"""),
    "sales_monthly": sql(f"""SELECT month, revenue, orders, customers, new_customers, profit, discount,
        customers - new_customers AS returning_customers, {rnd(ratio('revenue', 'orders'), 2)} AS aov,
        {growth('revenue', 'lag(revenue) OVER (ORDER BY month)')} AS mom_growth FROM (
        SELECT order_month AS month, {_sum('net_amount')} AS revenue, count(*) AS orders,
        count(DISTINCT customer_id) AS customers,
        count(DISTINCT CASE WHEN order_month = first_month THEN customer_id END) AS new_customers,
        {_sum('profit')} AS profit, {_sum('discount_amount')} AS discount
        FROM (SELECT *, min(order_month) OVER (PARTITION BY customer_id) AS first_month FROM rev) GROUP BY 1)"""),
    "sales_by_category": sql(f"""SELECT *, {pct('profit', 'revenue')} AS margin_pct,
        {pct('revenue', '(SELECT sum(net_amount) FROM rev)')} AS share_pct FROM (
        SELECT category, {_sum('CASE WHEN is_revenue THEN revenue END')} AS revenue,
        count(DISTINCT CASE WHEN is_revenue THEN order_id END) AS orders,
        {big('sum(CASE WHEN is_revenue THEN quantity END)')} AS units,
        {_sum('CASE WHEN is_revenue THEN profit END')} AS profit,
        {rnd(ratio('sum(discount_pct)', 'count(discount_pct)') + ' * 100', 2)} AS avg_discount_pct,
        {pct(_cnt("status = 'Returned'"), 'count(*)')} AS return_rate, {rnd('avg(rating)', 2)} AS avg_rating,
        count(DISTINCT product_id) AS products FROM lines GROUP BY category)"""),
    "sales_by_subcategory": sql(f"""SELECT category, sub_category, {_sum('revenue')} AS revenue,
        {big('sum(quantity)')} AS units, {_sum('profit')} AS profit FROM rlines GROUP BY 1, 2"""),
    "sales_by_city": sql(f"""SELECT g.*, {rnd(ratio('revenue', 'orders'), 2)} AS aov, n_nationkey * 1.5::DOUBLE AS lat,
        n_nationkey * 2.5::DOUBLE AS lon FROM (
        SELECT city, state, region, city_tier, {_sum('net_amount')} AS revenue, count(*) AS orders,
        count(DISTINCT customer_id) AS customers FROM rev WHERE city <> 'Unknown' GROUP BY 1, 2, 3, 4) g
        LEFT JOIN nation ON n_name = city"""),
    "sales_by_state": sql(f"""SELECT state, region, {_sum('net_amount')} AS revenue, count(*) AS orders,
        count(DISTINCT customer_id) AS customers FROM rev GROUP BY 1, 2"""),
    "sales_by_dimension": sql(_DIMENSIONS),
    "sales_by_channel": sql(_CHANNEL),
    "sales_dimensions": sql(f"""SELECT dimension, value, revenue, orders, cancel_rate, return_rate, aov, NULL::BIGINT AS customers
        FROM ({_DIMENSIONS}) UNION ALL SELECT dimension, value, revenue, orders, NULL, NULL, aov, customers FROM ({_CHANNEL})"""),
    "sales_heatmap": sql("""SELECT CAST(dayofweek(event_time) + 1 AS INTEGER) AS dow, CAST(hour(event_time) AS INTEGER) AS hour,
        count(*) AS orders, CAST(count(*) AS DOUBLE) AS revenue FROM clicks GROUP BY 1, 2"""),
    "sales_heatmap_orders": sql(f"""SELECT CAST(dayofweek(order_ts) + 1 AS INTEGER) AS dow,
        CAST(hour(order_ts) AS INTEGER) AS hour, count(*) AS orders, {_sum('net_amount')} AS revenue FROM rev GROUP BY 1, 2"""),
    "campaign_uplift": sql(f"""SELECT event || ' ' || year AS campaign, event, CAST(year AS INTEGER) AS year, start, days,
        revenue, {big('orders')} AS orders, avg_daily_revenue, avg_daily_orders,
        {rnd('(avg_daily_revenue / nullif(base_rev, 0) - 1) * 100', 2)} AS uplift_pct,
        {rnd('(avg_daily_orders / nullif(base_ord, 0) - 1) * 100', 2)} AS order_uplift_pct,
        {rnd('base_rev', 2)} AS baseline_daily_revenue, {rnd('base_ord', 1)} AS baseline_daily_orders
        FROM (SELECT r.*, {rnd(ratio('r.revenue', 'r.days'), 2)} AS avg_daily_revenue,
              {rnd(ratio('r.orders', 'r.days'), 1)} AS avg_daily_orders, base_rev, base_ord
              FROM runs r JOIN (
                SELECT u.event, u.year, {ratio('sum(t.net)', 'count(*)')} AS base_rev,
                       {ratio('sum(t.n)', 'count(*)')} AS base_ord
                FROM runs u JOIN tagged t ON t.event IS NULL AND t.date >= u.start - 28 AND t.date < u.start
                GROUP BY 1, 2) b USING (event, year))
        WHERE base_rev <> 0""", _SALE_DAYS, f"""tagged AS (
          SELECT d.*, s.event FROM (SELECT order_date AS date, sum(net_amount) AS net, count(*) AS n FROM rev GROUP BY 1) d
          LEFT JOIN sale_days s USING (date))""", f"""runs AS (
          SELECT event, year(date) AS year, min(date) AS start, count(*) AS days, {_sum('net')} AS revenue, sum(n) AS orders
          FROM tagged WHERE event IS NOT NULL GROUP BY 1, 2)"""),
    "product_stats": sql("""SELECT product_id, category, revenue, units, orders, buyers, avg_rating, ratings, return_rate,
        profit, views, carts, wishlists, view_to_buy_pct, cart_to_buy_pct, category_rank FROM pstats""", _PRODUCT_STATS),
    "top_products": sql("""SELECT product_id, product_name, revenue, units, category_rank FROM pstats
        ORDER BY revenue DESC, product_id LIMIT 6""", _PRODUCT_STATS),
    "funnel_overall": sql(f"SELECT * FROM ({_FUNNEL_STEPS}) WHERE dimension = 'all'", _FUNNEL),
    "funnel_by_dimension": sql(_FUNNEL_STEPS, _FUNNEL),
    "funnel_rates": sql(f"""SELECT dimension, value, n AS sessions, {pct('p', 'n')} AS conversion_rate,
        {rnd('(1 - CAST(p AS DOUBLE) / greatest(c, 1)) * 100', 2)} AS cart_abandonment_rate,
        {rnd(ratio('dur', 'n'), 1)} AS avg_duration_sec, {rnd(ratio('ev', 'n'), 2)} AS avg_events,
        {pct('b', 'n')} AS bounce_rate FROM fbase""", _FUNNEL),
    "traffic_hourly": sql(f"""SELECT CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS sessions,
        {big('sum(has_purchase)')} AS purchases FROM sessions GROUP BY 1"""),
    "traffic_monthly": sql(f"""SELECT *, {pct('purchases', 'sessions')} AS conversion_rate FROM (
        SELECT strftime(start_time, '%Y-%m') AS month, count(*) AS sessions, count(DISTINCT customer_id) AS visitors,
        {big('sum(has_purchase)')} AS purchases, {rnd('avg(duration_sec)', 1)} AS avg_duration_sec FROM sessions GROUP BY 1)"""),
    "event_counts": sql("SELECT event_type, count(*) AS events FROM clicks GROUP BY 1"),
    "cohort_retention": sql("SELECT * FROM cohort_rows", _COHORTS),
    "order_documents_flat": sql(f"""SELECT l.order_id, l.customer_id, l.status, line_no, product_id, product_name, category,
        quantity, {_ITEM_EDGE}, {_D['revenue']}, rating FROM lines l"""),
    "customer_profiles": sql("SELECT * FROM profiles", PROFILES),
    "preferred_value": sql("SELECT customer_id, preferred_device FROM profiles WHERE preferred_device IS NOT NULL", PROFILES),
}
PRODUCT_STATS_SQL = _PRODUCT_STATS
SALE_DAYS_SQL = _SALE_DAYS
