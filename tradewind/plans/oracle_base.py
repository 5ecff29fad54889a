"""The sample tables and the silver tables stated once more, in SQL, for the oracle."""

from __future__ import annotations

from tradewind.functions.vocab import DEVICES, SALE_EVENTS, TRAFFIC_SOURCES

SESSION_GAP_HOURS = 8


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST(({x}) AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, digits: int = 2) -> str:
    return rnd(f"{ratio(a, b)} * 100", digits)


def growth(a: str, b: str) -> str:
    return rnd(f"(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) / nullif(CAST({b} AS DOUBLE), 0) * 100", 2)


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def pick(values: list[str], index: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[CAST({index} AS INTEGER) + 1]"


def messy(x: str) -> str:
    return f"'  ' || lower({x}) || ' '"


_STATUS = """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Cancelled'
     WHEN o_orderstatus = 'P' THEN 'Returned' WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Delivered' END"""
_KIND = """CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
     WHEN 'signup' THEN 'checkout' ELSE event_type END"""

BRONZE = f"""
b_customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         'c' || c_custkey || '@example.com' AS email,
         CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         CAST(18 + c_custkey % 50 AS INTEGER) AS age,
         CASE WHEN c_custkey % 100 = 0 THEN '  ' WHEN c_custkey % 7 = 0 THEN {messy('n_name')} ELSE n_name END AS city,
         n_name AS state, r_name AS region, CAST(n_nationkey % 3 + 1 AS INTEGER) AS city_tier,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
         c_mktsegment AS acquisition_channel
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
b_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
         p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
         CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS cost_price,
         DATE '1994-01-01' + p_size AS launch_date
  FROM part),
b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
         CASE WHEN o_orderkey % 40 = 0 THEN {messy(f'({_STATUS})')} ELSE ({_STATUS}) END AS status,
         CASE WHEN o_orderkey % 50 = 0 THEN {messy('o_orderpriority')} ELSE o_orderpriority END AS payment_method,
         {pick(DEVICES, 'o_orderkey % 3')} AS device,
         CASE WHEN o_orderkey % 3 = 0 THEN 'SAVE' || (o_orderkey % 30) ELSE ' ' END AS coupon_code,
         CAST(CASE WHEN o_totalprice < 100000 THEN 49 ELSE 0 END AS DECIMAL(18,2)) AS shipping_fee
  FROM orders),
b_items0 AS (
  SELECT *, CAST(l_discount AS DECIMAL(4,2)) AS disc,
         CAST(round(CAST(l_extendedprice / l_quantity AS DECIMAL(28,8)), 2) AS DECIMAL(18,2)) AS per_unit
  FROM lineitem),
b_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
         CASE WHEN l_orderkey % 700 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         per_unit AS list_price, CAST(round(per_unit * (1 - disc), 2) AS DECIMAL(18,2)) AS unit_price,
         disc AS discount_pct,
         CASE WHEN l_orderkey % 100 < 55 THEN 1 + l_linenumber % 5 END AS rating
  FROM b_items0),
b_events0 AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, {_KIND} AS kind FROM events),
b_events AS (
  SELECT event_id, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, user_id AS customer_id, ts AS event_time,
         CASE WHEN event_id % 30 = 0 THEN upper(kind) ELSE kind END AS event_type,
         CASE WHEN event_id % 40 <> 7 THEN k END AS product_id,
         {pick(DEVICES, 'k % 3')} AS device, {pick(TRAFFIC_SOURCES, 'k % 6')} AS traffic_source
  FROM b_events0)
"""

SILVER = f"""
customers AS (
  SELECT b.customer_id, first_name, last_name, email, gender, age,
         CASE WHEN trim(b.city) = '' THEN 'Unknown' ELSE n_name END AS city, state, region, city_tier, signup_date,
         acquisition_channel, first_name || ' ' || last_name AS full_name
  FROM b_customers b LEFT JOIN nation ON lower(trim(b.city)) = lower(n_name)),
products AS (
  SELECT *, {rnd('1 - CAST(cost_price AS DOUBLE) / nullif(CAST(list_price AS DOUBLE), 0)', 4)} AS margin_pct
  FROM b_products WHERE list_price > 0),
orders_clean AS (
  SELECT order_id, customer_id, order_ts, upper(trim(status)[1]) || lower(trim(status)[2:]) AS status,
         upper(trim(payment_method)) AS payment_method, device, nullif(trim(coupon_code), '') AS coupon_code,
         shipping_fee
  FROM b_orders WHERE order_ts IS NOT NULL AND customer_id IS NOT NULL),
items AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY product_id NULLS FIRST, quantity NULLS FIRST,
             list_price NULLS FIRST, unit_price NULLS FIRST, discount_pct NULLS FIRST, rating NULLS FIRST) AS rn
    FROM b_items WHERE quantity > 0 AND unit_price > 0) WHERE rn = 1),
clicks AS (
  SELECT * FROM (SELECT * REPLACE (lower(trim(event_type)) AS event_type) FROM b_events)
  WHERE event_type IN ('page_view','product_view','add_to_cart','remove_from_cart','add_to_wishlist','checkout','purchase')
    AND NOT (event_type = 'product_view' AND product_id IS NULL)),
priced AS (
  SELECT i.*, p.product_name, p.category, p.sub_category, p.brand, p.cost_price,
         CAST(i.quantity * i.unit_price AS DECIMAL(18,2)) AS revenue,
         CAST(i.quantity * i.list_price AS DECIMAL(18,2)) AS gross_value,
         CAST(i.quantity * p.cost_price AS DECIMAL(18,2)) AS cost,
         CAST(i.quantity * i.unit_price - i.quantity * p.cost_price AS DECIMAL(18,2)) AS profit,
         CAST(i.quantity * i.list_price - i.quantity * i.unit_price AS DECIMAL(18,2)) AS discount_amount
  FROM items i JOIN products p USING (product_id)),
lines AS (
  SELECT p.*, o.customer_id, o.order_ts, o.status, o.payment_method, o.device, CAST(o.order_ts AS DATE) AS order_date,
         o.status NOT IN ('Cancelled', 'Returned') AS is_revenue
  FROM priced p JOIN orders_clean o USING (order_id)),
totals AS (
  SELECT order_id, count(*) AS items_count, sum(quantity) AS units, sum(gross_value) AS gross_value,
         sum(revenue) AS net_amount, sum(discount_amount) AS discount_amount, sum(profit) AS profit,
         list_sort(list(DISTINCT category)) AS categories
  FROM priced GROUP BY order_id),
s_orders AS (
  SELECT o.*, t.* EXCLUDE (order_id), c.city, c.state, c.region, c.city_tier, CAST(o.order_ts AS DATE) AS order_date,
         strftime(o.order_ts, '%Y-%m') AS order_month, o.status NOT IN ('Cancelled', 'Returned') AS is_revenue,
         o.coupon_code IS NOT NULL AS coupon_used
  FROM orders_clean o JOIN totals t USING (order_id) LEFT JOIN customers c USING (customer_id)),
rev AS (SELECT * FROM s_orders WHERE is_revenue),
rlines AS (SELECT * FROM lines WHERE is_revenue),
gaps AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY customer_id ORDER BY event_time, event_id)
                      < INTERVAL {SESSION_GAP_HOURS} HOUR THEN 0 ELSE 1 END AS is_start
  FROM clicks),
numbered AS (
  SELECT *, sum(is_start) OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS session_no FROM gaps),
sessions AS (
  SELECT customer_id || '-' || session_no AS session_id, customer_id, min(event_time) AS start_time,
         max(event_time) AS end_time, count(*) AS events,
         {big("sum(CASE WHEN event_type = 'product_view' THEN 1 ELSE 0 END)")} AS product_views,
         max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS has_cart,
         max(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) AS has_checkout,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase,
         arg_min(device, (event_time, event_id)) AS device, arg_min(traffic_source, (event_time, event_id)) AS traffic_source,
         {big("epoch(date_trunc('second', max(event_time))) - epoch(date_trunc('second', min(event_time)))")} AS duration_sec,
         CASE WHEN sum(CASE WHEN event_type = 'product_view' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS has_view,
         CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS is_bounce, CAST(min(event_time) AS DATE) AS session_date
  FROM numbered GROUP BY customer_id, session_no),
ref_day AS (SELECT max(order_date) AS d FROM s_orders),
sess_day AS (SELECT max(session_date) AS d FROM sessions),
sale_events(pos, event, m, dd, len) AS (VALUES
  {', '.join(f"({i}, '{n}', {m}, {d}, {l})" for i, (n, m, d, l) in enumerate(SALE_EVENTS))})
"""

PREFIX = f"WITH {BRONZE.strip()},\n{SILVER.strip()}"


def sql(body: str, *ctes: str) -> str:
    """The shared tables, further CTEs, then the query."""
    return ",\n".join([PREFIX, *ctes]) + "\n" + body
