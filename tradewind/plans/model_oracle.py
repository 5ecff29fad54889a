"""Oracle SQL of the queries in model_queries."""

from __future__ import annotations

from tradewind.functions.vocab import CITY_COORDINATES, REASON_GENERIC, REASON_KNOWN, SEGMENT_ACTIONS
from tradewind.operators.churn import label_of
from tradewind.operators.features import CHURN_NUMERIC, RFM_FEATURES
from tradewind.operators.forecast import ALL_SERIES, Z80, Z95
from tradewind.operators.segment import CLUSTER_FEATURES, FALLBACK_NAMES
from tradewind.plans.gold_queries import (
    ORACLE as GOLD,
    PRODUCT_STATS_SQL as PSTATS,
    PROFILES,
    SALE_DAYS_SQL as SALE_DAYS,
)
from tradewind.plans.model_queries import DAILY_Z, IQR_MULTIPLIER, OVERVIEW, PAIR_LIFT, PAIR_SUPPORT, PERIOD, SCENARIOS, TRUTH
from tradewind.plans.oracle_base import big, dbl, growth, pct, ratio, rnd, sql
from tradewind.plans.sample import SAMPLE_LOGIT

BINARY_COLUMNS = ["tp", "fp", "fn", "tn", "auc", "auc_pr", "accuracy", "precision", "recall", "f1"]
START, END = (f"DATE '{d}'" for d in PERIOD)


def _body(key: str) -> str:
    """The CTEs and query of another oracle entry without the shared prefix, as a subquery."""
    return f"({GOLD[key]})"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cnt(cond: str) -> str:
    return big(f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)")


# --------------------------------------------------------------------- features
RFM = f"""rfm AS (
  SELECT customer_id, CAST(datediff('day', max(order_date), (SELECT d FROM ref_day)) AS INTEGER) AS recency_days,
         count(*) AS frequency, {dbl('sum(net_amount)')} AS monetary, {rnd(ratio('sum(net_amount)', 'count(*)'), 2)} AS aov,
         CAST(datediff('day', min(order_date), (SELECT d FROM ref_day)) AS INTEGER) AS tenure_days,
         any_value(category_diversity) AS category_diversity,
         {rnd('avg(' + ratio('discount_amount', 'gross_value') + ') * 100', 2)} AS avg_discount_pct
  FROM rev JOIN (SELECT customer_id, count(DISTINCT category) AS category_diversity FROM rlines GROUP BY 1) USING (customer_id)
  GROUP BY customer_id)"""

SCORES = """scores AS (
  SELECT customer_id, CAST(6 - r AS INTEGER) AS R, CAST(f AS INTEGER) AS F, CAST(m AS INTEGER) AS M,
         (6 - r) || '' || f || '' || m AS score FROM (
    SELECT customer_id, ntile(5) OVER (ORDER BY recency_days, customer_id) AS r,
           ntile(5) OVER (ORDER BY frequency, customer_id) AS f, ntile(5) OVER (ORDER BY monetary, customer_id) AS m
    FROM rfm))"""

CLUSTERED = """clustered AS (
  SELECT rfm.*, CAST(floor((R + F + M - 3) / 3) AS INTEGER) AS prediction FROM rfm JOIN scores USING (customer_id))"""

_AVGS = ", ".join(f"avg({c}) AS avg_{c}" for c in RFM_FEATURES)
CLUSTER_PROFILE = f"""cprofile AS (
  SELECT *, (lf - (SELECT avg(ln(1 + frequency)) FROM clustered)) / (SELECT stddev_samp(ln(1 + frequency)) FROM clustered)
          + (lm - (SELECT avg(ln(1 + monetary)) FROM clustered)) / (SELECT stddev_samp(ln(1 + monetary)) FROM clustered) AS worth
  FROM (SELECT prediction AS cluster, count(*) AS customers, {_AVGS}, avg(ln(1 + frequency)) AS lf,
               avg(ln(1 + monetary)) AS lm, sum(monetary) AS revenue FROM clustered GROUP BY prediction))"""


def _names(*values: str) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


NAMES = f"""cordered AS (
  SELECT *, row_number() OVER (ORDER BY worth DESC) AS pos, list_concat(
    CASE WHEN avg_recency_days <= 90 AND avg_tenure_days < 150 AND avg_frequency < 2.5
           THEN {_names('New & Promising', 'Potential Loyalists')}
         WHEN avg_recency_days <= 90 THEN {_names('Champions', 'Loyal Customers', 'Potential Loyalists')}
         WHEN avg_recency_days <= 240 AND avg_frequency >= 2.5 THEN {_names('At Risk', 'Needs Attention')}
         WHEN avg_recency_days <= 240 THEN {_names('Needs Attention', 'About to Sleep')}
         WHEN avg_frequency >= 4 THEN {_names("Can't Lose Them", 'Hibernating')}
         ELSE {_names('Hibernating', 'Lost')} END, {_names(*FALLBACK_NAMES)}) AS cands FROM cprofile),
named(pos, cluster, segment, used) AS (
  SELECT 0::BIGINT, -1, ''::VARCHAR, []::VARCHAR[]
  UNION ALL
  SELECT o.pos, o.cluster, list_filter(o.cands, lambda x: NOT list_contains(n.used, x))[1],
         list_append(n.used, list_filter(o.cands, lambda x: NOT list_contains(n.used, x))[1])
  FROM named n JOIN cordered o ON o.pos = n.pos + 1)"""

SEGMENTED = """segmented AS (
  SELECT customer_id, named.segment FROM clustered JOIN named ON prediction = cluster)"""


def churn_ctes(name: str, as_of: str, seen_at: str) -> str:
    r90, r180 = f"{as_of} - 90", f"{as_of} - 180"
    s30, s90, s180 = f"{seen_at} - 30", f"{seen_at} - 90", f"{seen_at} - 180"
    return f"""{name} AS (
  WITH past AS (SELECT * FROM s_orders WHERE order_date < {as_of}),
  base AS (
    SELECT customer_id, CAST(datediff('day', max(order_date), {as_of}) AS INTEGER) AS recency_days, count(*) AS frequency,
           {dbl('sum(net_amount)')} AS monetary, {ratio('sum(net_amount)', 'count(*)')} AS aov,
           CAST(datediff('day', min(order_date), {as_of}) AS INTEGER) AS tenure_days,
           {cnt(f'order_date >= {r90}')} AS orders_90d,
           {cnt(f'order_date >= {r180} AND order_date < {r90}')} AS orders_prev_90d,
           coalesce({dbl(f'sum(CASE WHEN order_date >= {r90} THEN net_amount END)')}, 0) AS spend_90d,
           avg({ratio('discount_amount', 'gross_value')}) * 100 AS avg_discount_pct
    FROM past WHERE is_revenue GROUP BY 1),
  placed AS (
    SELECT customer_id, avg(CASE WHEN status = 'Returned' THEN 1 ELSE 0 END) AS return_rate,
           avg(CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END) AS cancel_rate,
           avg(CASE WHEN payment_method = '1-URGENT' THEN 1 ELSE 0 END) AS cod_share FROM past GROUP BY 1),
  dev AS (
    SELECT customer_id, device AS preferred_device FROM (
      SELECT customer_id, device, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, device) AS rn
      FROM past GROUP BY 1, 2) WHERE rn = 1),
  div AS (SELECT customer_id, count(DISTINCT category) AS category_diversity FROM rlines WHERE order_date < {as_of} GROUP BY 1),
  visits AS (
    SELECT customer_id, {cnt(f'session_date >= {s30}')} AS sessions_30d, {cnt(f'session_date >= {s90}')} AS sessions_90d,
           CAST(datediff('day', max(session_date), {seen_at}) AS INTEGER) AS days_since_last_session,
           coalesce(1 - {ratio(cnt(f'session_date >= {s180} AND has_cart = 1 AND has_purchase = 1'),
                               cnt(f'session_date >= {s180} AND has_cart = 1'))}, 0.0) AS cart_abandon_rate
    FROM sessions WHERE session_date < {seen_at} GROUP BY 1)
  SELECT b.customer_id, recency_days, frequency, monetary, aov, tenure_days, orders_90d, orders_prev_90d, spend_90d,
         coalesce(sessions_30d, 0) AS sessions_30d, coalesce(sessions_90d, 0) AS sessions_90d,
         coalesce(days_since_last_session, 365) AS days_since_last_session,
         coalesce(cart_abandon_rate, 0.0) AS cart_abandon_rate, avg_discount_pct, return_rate, cancel_rate,
         coalesce(category_diversity, 1) AS category_diversity, cod_share, c.age, c.city_tier, preferred_device,
         c.acquisition_channel
  FROM base b LEFT JOIN placed USING (customer_id) LEFT JOIN dev USING (customer_id) LEFT JOIN div USING (customer_id)
  LEFT JOIN visits USING (customer_id) LEFT JOIN customers c USING (customer_id))"""


_AS_OF, _SEEN = "(SELECT d FROM ref_day)", "(SELECT d FROM sess_day)"
TRAINING = churn_ctes("training", f"({_AS_OF} - 89)", f"({_SEEN} + 1)")
CURRENT = churn_ctes("current", f"({_AS_OF} + 1)", f"({_SEEN} + 1)").replace("current AS (", "today AS (", 1)


def _term(t) -> str:
    if "_ohe_" in t.name:
        column, label = t.name.split("_ohe_", 1)
        value = f"CASE WHEN {column} = {quote(label)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    elif t.name.startswith("log_"):
        value = f"ln(1 + greatest({dbl(t.name[4:])}, 0))"
    else:
        value = dbl(t.name)
    if t.std == 0:
        return "0.0::DOUBLE"
    return f"{t.weight!r}::DOUBLE * (({value} - {t.mean!r}::DOUBLE) / {t.std!r}::DOUBLE)"


_LOGIT = f"{SAMPLE_LOGIT.intercept!r}::DOUBLE + " + " + ".join(f"({_term(t)})" for t in SAMPLE_LOGIT.terms)
_P = f"(1 / (1 + exp(-({_LOGIT}))))"


def band(p: str) -> str:
    return f"CASE WHEN {p} >= 0.7 THEN 'High' WHEN {p} >= 0.4 THEN 'Medium' ELSE 'Low' END"


VALUED = f"""scored AS (SELECT *, {rnd(_P, 4)} AS churn_probability FROM today),
valued AS (
  SELECT *, {band('churn_probability')} AS churn_risk, monetary / (greatest(tenure_days, 30) / 30.0::DOUBLE) AS monthly_spend,
         {rnd('monetary / (greatest(tenure_days, 30) / 30.0::DOUBLE) * 12 * (1 - churn_probability)', 2)} AS clv_12m
  FROM scored)"""
SCORED_PROFILES = """sprofiles AS (
  SELECT p.* EXCLUDE (segment), v.churn_probability, v.churn_risk, v.clv_12m, coalesce(g.segment, p.segment) AS segment
  FROM profiles p LEFT JOIN valued v USING (customer_id) LEFT JOIN segmented g USING (customer_id))"""
_PROFILE_CTES = (PROFILES, RFM, SCORES, CLUSTERED, CLUSTER_PROFILE, NAMES, SEGMENTED, CURRENT, VALUED, SCORED_PROFILES)


def rsql(body: str, *ctes: str) -> str:
    """Like sql(), for queries that need the recursive naming step."""
    return sql(body, *ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def profiles_sql(body: str) -> str:
    return rsql(body, *_PROFILE_CTES)


# --------------------------------------------------------------------- interactions
PAIRS = f"""pairs AS (
  SELECT coalesce(e.customer_id, b.customer_id) AS customer_id, coalesce(e.product_id, b.product_id) AS product_id,
         coalesce(carts, 0) AS carts, coalesce(wish, 0) AS wish, coalesce(views, 0) AS views, coalesce(buys, 0) AS buys
  FROM (SELECT customer_id, product_id, {cnt("event_type = 'add_to_cart'")} AS carts,
               {cnt("event_type = 'add_to_wishlist'")} AS wish, {cnt("event_type = 'product_view'")} AS views
        FROM clicks WHERE product_id IS NOT NULL GROUP BY 1, 2) e
  FULL JOIN (SELECT customer_id, product_id, count(*) AS buys FROM lines WHERE status <> 'Cancelled' GROUP BY 1, 2) b
  ON e.customer_id = b.customer_id AND e.product_id = b.product_id),
strengths AS (
  SELECT *, least(30.0::DOUBLE, CAST(5 * buys + 2 * carts + 1.5 * wish + 0.5 * views AS DOUBLE)) AS strength FROM pairs)"""

HOLDOUT = """purchases AS (
  SELECT customer_id, product_id, row_number() OVER (PARTITION BY customer_id ORDER BY order_ts DESC, product_id DESC) AS rn
  FROM lines WHERE status <> 'Cancelled'),
holdout AS (
  SELECT customer_id, product_id FROM purchases WHERE rn = 1
    AND customer_id IN (SELECT customer_id FROM purchases GROUP BY 1 HAVING count(DISTINCT product_id) >= 3)
    AND (customer_id, product_id) NOT IN (SELECT (customer_id, product_id) FROM purchases WHERE rn > 1))"""

POPULAR = """train AS (SELECT p.* FROM pairs p ANTI JOIN holdout h ON p.customer_id = h.customer_id AND p.product_id = h.product_id),
candidates AS (SELECT product_id, sum(buys)::BIGINT AS score FROM train GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 150),
poptop AS (
  SELECT * FROM (
    SELECT h.customer_id, c.product_id, c.score,
           CAST(row_number() OVER (PARTITION BY h.customer_id ORDER BY c.score DESC, c.product_id) AS INTEGER) AS rank
    FROM holdout h CROSS JOIN candidates c
    ANTI JOIN (SELECT * FROM train WHERE buys > 0) t ON t.customer_id = h.customer_id AND t.product_id = c.product_id)
  WHERE rank <= 10)"""

# --------------------------------------------------------------------- rules
RULES = f"""bitems AS (SELECT DISTINCT order_id, sub_category AS item FROM lines WHERE status <> 'Cancelled'),
nb AS (SELECT count(DISTINCT order_id) AS n FROM bitems),
singles AS (SELECT item, count(*) AS n FROM bitems GROUP BY 1),
both_items AS (
  SELECT a.item AS x, b.item AS y, count(*) AS n FROM bitems a JOIN bitems b ON a.order_id = b.order_id AND a.item <> b.item
  GROUP BY 1, 2),
prules AS (
  SELECT x AS antecedent, y AS consequent, {rnd(ratio('p.n', 'nb.n'), 5)} AS support, {rnd(ratio('p.n', 'sx.n'), 4)} AS confidence,
         {rnd(f"{ratio('p.n', 'sx.n')} / {ratio('sy.n', 'nb.n')}", 3)} AS lift
  FROM both_items p JOIN singles sx ON sx.item = x JOIN singles sy ON sy.item = y CROSS JOIN nb
  WHERE p.n >= ceil({PAIR_SUPPORT} * nb.n) AND {ratio('p.n', 'sx.n')} >= 0.05
    AND {ratio('p.n', 'sx.n')} / {ratio('sy.n', 'nb.n')} >= {PAIR_LIFT})"""

# --------------------------------------------------------------------- series
DAYS = f"""raw_days AS (
  SELECT '{ALL_SERIES}' AS series, order_date AS date, {dbl('sum(net_amount)')} AS revenue, count(*) AS orders FROM rev GROUP BY 2
  UNION ALL
  SELECT category, order_date, {dbl('sum(revenue)')}, count(DISTINCT order_id) FROM rlines GROUP BY 1, 2),
spine AS (
  SELECT series, CAST(unnest(generate_series((SELECT min(order_date) FROM rev), (SELECT d FROM ref_day), INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT series FROM raw_days)),
days AS (
  SELECT s.series, s.date, coalesce(r.revenue, 0) AS revenue, coalesce(r.orders, 0) AS orders
  FROM spine s LEFT JOIN raw_days r ON r.series = s.series AND r.date = s.date),
edges AS (SELECT CAST(max(date) - 60 AS DATE) AS e, max(date) AS last FROM days)"""


def calendar(table: str, name: str) -> str:
    return f"""{name} AS (
  SELECT t.*, CAST(isodow(t.date) - 1 AS INTEGER) AS dow, CAST(month(t.date) AS INTEGER) AS month,
         CAST(day(t.date) AS INTEGER) AS dom, CASE WHEN isodow(t.date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN day(t.date) <= 5 THEN 1 ELSE 0 END AS is_salary,
         CASE WHEN sd.date IS NOT NULL THEN 1 ELSE 0 END AS sale_flag, CAST(coalesce(sd.sale_day, -1) AS INTEGER) AS sale_day,
         CAST(datediff('day', t.date, CAST(date_trunc('month', t.date) + INTERVAL 1 MONTH AS DATE)) AS INTEGER) AS days_to_month_end
  FROM {table} t LEFT JOIN sale_days sd ON sd.date = t.date)"""


def hybrid(p: str, value: str, train: str, frame: str) -> list[str]:
    """CTEs <p>_*: trend plus calendar means of `value` fitted on `train`, applied to `frame`."""
    return [
        f"""{p}_trend AS (
  SELECT series, min(start) AS start, regr_intercept(ln(1 + v), t) AS b, regr_slope(ln(1 + v), t) AS a FROM (
    SELECT series, date, {dbl(value)} AS v, min(date) OVER (PARTITION BY series) AS start,
           datediff('day', min(date) OVER (PARTITION BY series), date) AS t FROM {train}) GROUP BY series)""",
        calendar(train, f"{p}_cal"),
        f"""{p}_base AS (
  SELECT c.*, {dbl('c.' + value)} AS v, b + a * datediff('day', start, date) AS trend FROM {p}_cal c JOIN {p}_trend USING (series))""",
        f"""{p}_eff AS (
  SELECT series, dow, month, sale_flag, avg(ln(1 + v) - trend) AS effect, count(*) AS days FROM {p}_base GROUP BY ALL)""",
        f"""{p}_spread AS (
  SELECT series, avg(exp(r)) AS smear, stddev_pop(r) AS sigma FROM (
    SELECT series, ln(1 + v) - ln(1 + greatest(exp(trend + effect) - 1, 0)) AS r
    FROM {p}_base JOIN {p}_eff USING (series, dow, month, sale_flag)) GROUP BY series)""",
        calendar(frame, f"{p}_fcal"),
        f"""{p}_pred AS (
  SELECT c.*, greatest(exp(b + a * datediff('day', start, c.date) + coalesce(effect, 0)) - 1, 0) * smear AS yhat, sigma
  FROM {p}_fcal c JOIN {p}_trend USING (series) JOIN {p}_spread USING (series)
  LEFT JOIN {p}_eff USING (series, dow, month, sale_flag))""",
    ]


# normal equations summed per series and swept column by column; a column that depends on earlier ones gets coefficient 0
LEAST_SQUARES = [
    calendar("days", "lcal"),
    f"""designed AS (
  SELECT series, date, {dbl('revenue')} AS v, list_concat(
    [1.0::DOUBLE, datediff('day', min(date) OVER (PARTITION BY series), date) / 365.0::DOUBLE],
    list_transform(range(1, 7), lambda d: (dow = d)::INT::DOUBLE), list_transform(range(2, 13), lambda m: (month = m)::INT::DOUBLE),
    [is_salary::DOUBLE, sale_flag::DOUBLE]) AS x FROM lcal)""",
    """crossed AS (
  SELECT series, i, j, sum(z[i] * z[j]) AS s
  FROM (SELECT series, list_append(x, ln(1 + v)) AS z FROM designed, edges WHERE date <= e), range(1, 23) a(i), range(1, 23) b(j) GROUP BY ALL)""",
    """gram AS (
  SELECT series, list(r ORDER BY i) AS m FROM (SELECT series, i, list(s ORDER BY j) AS r FROM crossed GROUP BY 1, 2) GROUP BY 1)""",
    """swept(series, k, m, squares, kept) AS (
  SELECT series, 0, m, list_transform(range(1, 22), lambda i: m[i][i]), []::BOOLEAN[] FROM gram
  UNION ALL
  SELECT series, k + 1, CASE WHEN m[k + 1][k + 1] <= 1e-9 * squares[k + 1] THEN m ELSE
    list_transform(range(1, 23), lambda i: CASE WHEN i = k + 1 THEN list_transform(range(1, 23), lambda j: m[k + 1][j] / m[k + 1][k + 1])
      ELSE list_transform(range(1, 23), lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) END,
    squares, list_append(kept, m[k + 1][k + 1] > 1e-9 * squares[k + 1]) FROM swept WHERE k < 21)""",
    "fits AS (SELECT series, list_transform(range(1, 22), lambda i: CASE WHEN kept[i] THEN m[i][22] ELSE 0 END) AS b FROM swept WHERE k = 21)",
]
FUTURE = """future AS (
  SELECT series, CAST(unnest(generate_series(max(date) + 1, max(date) + 60, INTERVAL 1 DAY)) AS DATE) AS date FROM days GROUP BY series)"""
TOTAL = f"total_days AS (SELECT * FROM days WHERE series = '{ALL_SERIES}')"
SPLIT = """past_days AS (SELECT d.* FROM days d, edges WHERE date <= e),
test_days AS (SELECT d.* FROM days d, edges WHERE date > e)"""
NAIVE = """naive AS (
  SELECT t.series, t.date, t.revenue AS actual, s.revenue AS predicted FROM test_days t CROSS JOIN edges
  JOIN past_days s ON s.series = t.series AND s.date = e - 6 + CAST((datediff('day', e, t.date) - 1) % 7 AS INTEGER))"""
AVERAGE = """average AS (
  SELECT t.series, t.date, t.revenue AS actual, m.predicted FROM test_days t JOIN (
    SELECT series, avg(revenue) AS predicted FROM past_days, edges WHERE date > e - 28 GROUP BY series) m USING (series))"""

REGRESSION = f"""placed AS (
  SELECT *, count(*) OVER w AS n, row_number() OVER (PARTITION BY series, model ORDER BY date) - 1 AS i, avg(actual) OVER w AS m
  FROM runs WINDOW w AS (PARTITION BY series, model)),
dailym AS (
  SELECT series, model, {rnd('avg(CASE WHEN actual > 0 THEN abs((actual - predicted) / actual) END) * 100', 2)} AS mape,
         {rnd('sqrt(avg((actual - predicted) * (actual - predicted)))', 2)} AS rmse,
         {rnd('avg(abs(actual - predicted))', 2)} AS mae,
         {rnd('1 - sum((actual - predicted) * (actual - predicted)) / nullif(sum((actual - m) * (actual - m)), 0)', 4)} AS r2
  FROM placed GROUP BY 1, 2),
weeklym AS (
  SELECT series, model, {rnd('avg(abs(wy - wp) / nullif(wy, 0)) * 100', 2)} AS weekly_mape FROM (
    SELECT series, model, (n - 1 - i) // 7 AS w, sum(actual) AS wy, sum(predicted) AS wp FROM placed
    WHERE (n - 1 - i) // 7 < n // 7 GROUP BY ALL) GROUP BY 1, 2)"""

# --------------------------------------------------------------------- anomalies
ANOMALIES = [
    DAYS, SALE_DAYS, TOTAL, *hybrid("cn", "orders", "total_days", "total_days"),
    *hybrid("mo", "revenue", "total_days", "total_days"),
    """resid AS (
  SELECT c.series, c.date, c.orders, c.yhat AS expected_orders, m.revenue, m.yhat AS expected_revenue,
         ln(1 + c.orders::DOUBLE) - ln(1 + c.yhat) AS r
  FROM cn_pred c JOIN mo_pred m USING (series, date))""",
    f"""zs AS (
  SELECT *, (r - med) / mad AS z FROM resid, (SELECT median(r) AS med FROM resid),
    (SELECT CASE WHEN x = 0 THEN 1e-6 ELSE x END AS mad FROM (
      SELECT median(abs(r - (SELECT median(r) FROM resid))) * 1.4826 AS x FROM resid)))""",
    f"""danom AS (
  SELECT 'daily_revenue' AS type, series, date, {rnd('revenue', 2)} AS actual, {rnd('expected_revenue', 2)} AS expected,
         {big('orders')} AS orders, {rnd('expected_orders', 1)} AS expected_orders, {rnd('z', 2)} AS z_score,
         CASE WHEN z > 0 THEN 'spike' ELSE 'drop' END AS direction,
         {rnd('(' + ratio('orders', 'expected_orders') + ' - 1) * 100', 2)} AS deviation_pct,
         CASE WHEN abs(z) >= 7 THEN 'critical' ELSE 'warning' END AS severity
  FROM zs WHERE abs(z) >= {DAILY_Z})""",
]
HIGH = f"""fence AS (
  SELECT q3 + {IQR_MULTIPLIER} * (q3 - q1) AS f FROM (
    SELECT quantile_cont(net_amount::DOUBLE, 0.25) AS q1, quantile_cont(net_amount::DOUBLE, 0.75) AS q3 FROM rev)),
high AS (
  SELECT 'high_value_order' AS type, order_date AS date, order_id, customer_id, {dbl('net_amount')} AS actual,
         {rnd('f', 2)} AS expected, payment_method, 'info' AS severity, 'spike' AS direction
  FROM rev, fence WHERE net_amount::DOUBLE > f ORDER BY net_amount DESC, order_id LIMIT 40)"""
ABUSE = f"""abuse AS (
  SELECT 'return_abuse' AS type, customer_id, orders, returns, {rnd('rate * 100', 1)} AS return_rate, {rnd('val', 2)} AS actual,
         'warning' AS severity, 'spike' AS direction FROM (
    SELECT *, {ratio('returns', 'orders')} AS rate FROM (
      SELECT customer_id, count(*) AS orders, {cnt("status = 'Returned'")} AS returns,
             {dbl("sum(CASE WHEN status = 'Returned' THEN net_amount ELSE 0 END)")} AS val FROM s_orders GROUP BY 1))
  WHERE returns >= 3 AND rate >= 0.4 ORDER BY rate DESC, customer_id LIMIT 40)"""

# --------------------------------------------------------------------- label metrics
LABELLED = f"""labelled AS (
  SELECT doc_id, {rnd('least(1.0::DOUBLE, n_chars / 4000.0::DOUBLE)', 4)} AS score, quality AS label
  FROM labels JOIN documents USING (doc_id)),
pn AS (SELECT {cnt('label = 1')} AS p, {cnt('label <> 1')} AS n FROM labelled)"""
BINARY = f"""conf AS (
  SELECT {cnt('label = 1 AND score > 0.5')} AS tp, {cnt('label <> 1 AND score > 0.5')} AS fp,
         {cnt('label = 1 AND score <= 0.5')} AS fn, {cnt('label <> 1 AND score <= 0.5')} AS tn FROM labelled),
auc AS (
  SELECT (sum(CASE WHEN label = 1 THEN r END) - max(p) * (max(p) + 1) / 2.0) / (max(p) * max(n)) AS v FROM (
    SELECT label, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r,
           p, n FROM labelled, pn)),
curve AS (
  SELECT s, pos, sum(pos) OVER (ORDER BY s DESC) / (sum(pos) OVER (ORDER BY s DESC) + sum(neg) OVER (ORDER BY s DESC)) AS precision
  FROM (SELECT score AS s, {cnt('label = 1')} AS pos, {cnt('label <> 1')} AS neg FROM labelled GROUP BY 1)),
aucpr AS (
  SELECT sum(pos * (precision + before) / 2) / (SELECT p FROM pn) AS v FROM (
    SELECT *, coalesce(lag(precision) OVER (ORDER BY s DESC), precision) AS before FROM curve))"""

_TREND_COLS = f"""count(DISTINCT date) AS days, sum(revenue) AS r, {big('sum(orders)')} AS orders, {big('sum(units)')} AS units,
  sum(profit) AS pr"""


def trend(unit: str, source: str) -> str:
    key = "date" if unit == "day" else f"CAST(date_trunc('{unit}', date) AS DATE)"
    return f"""SELECT period, is_total, {rnd('r', 2)} AS revenue, orders, units, {rnd('pr', 2)} AS profit, days,
      coalesce({rnd(ratio('r', 'orders'), 2)}, 0) AS aov FROM (
        SELECT period, 0 AS is_total, {_TREND_COLS} FROM (SELECT *, {key} AS period FROM {source}) GROUP BY period
        UNION ALL SELECT NULL, 1, {_TREND_COLS} FROM {source})"""


DAILY = f"daily AS (SELECT * FROM {_body('sales_daily')} WHERE date BETWEEN {START} AND {END})"
DAILY_CAT = f"dcat AS (SELECT * FROM {_body('sales_daily_category')} WHERE date BETWEEN {START} AND {END})"

_MEDIAN = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {rnd('v', 4)} AS median FROM (
      SELECT {dbl(c)} AS v, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n FROM today) WHERE rn = n // 2 + 1"""
    for c in CHURN_NUMERIC)

_SCENARIO = " UNION ALL ".join(
    "SELECT * REPLACE (" + ", ".join(
        f"{quote(v) if isinstance(v, str) else v} AS {c}" for c, v in changes.items()) + f"), '{name}' AS scenario FROM today"
    if changes else f"SELECT *, '{name}' AS scenario FROM today" for name, changes in SCENARIOS.items())

_DRIVERS = " UNION ALL ".join(
    f"""SELECT customer_id, {i} AS no, {quote(label_of(t.name))} AS feature, {quote(t.name.replace('log_', ''))} AS key,
      {rnd(_term(t), 4)} AS contribution FROM today""" for i, t in enumerate(SAMPLE_LOGIT.terms))

_ROUND6 = ["aov", "monetary", "spend_90d", "cart_abandon_rate", "avg_discount_pct", "return_rate", "cancel_rate", "cod_share"]
_SEGMENT_COLS = ", ".join(f"{rnd(f'avg_{c}', 2)} AS avg_{c}" for c in RFM_FEATURES)
_ACTIONS = "actions(segment, action) AS (VALUES " + ", ".join(f"({quote(k)}, {quote(v)})" for k, v in SEGMENT_ACTIONS.items()) + ")"
_SCALED = ", ".join(
    rnd(f"({x} - (SELECT avg({x}) FROM rfm)) / (SELECT stddev_samp({x}) FROM rfm)", 6) + f" AS z_{c}"
    for c, x in ((c, f"ln(1 + {c[4:]})" if c.startswith("log_") else dbl(c)) for c in CLUSTER_FEATURES))
_WINBACK = """SELECT customer_id, full_name AS name, email, city, segment, orders, total_spent,
  recency_days AS days_since_last_order, churn_probability, churn_risk AS risk, clv_12m AS predicted_12m_value,
  favourite_category FROM sprofiles WHERE churn_risk = 'High' ORDER BY clv_12m DESC, customer_id LIMIT 1000"""

ORACLE = {
    # ------------------------------------------------------------------ sources and sinks
    "io_csv_roundtrip": sql(f"""SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
        {big('epoch(order_ts)')} AS order_ts, status, payment_method, device, coupon_code, {dbl('shipping_fee')} AS shipping_fee
        FROM b_orders"""),
    "io_jsonl_roundtrip": sql(f"""SELECT CAST(product_id AS VARCHAR) AS product_id, product_name, category, sub_category, brand,
        {dbl('list_price')} AS list_price, {dbl('cost_price')} AS cost_price, launch_date FROM b_products"""),
    "io_jsonl_dir": sql(f"""SELECT event_type, device, count(*) AS events, count(product_id) AS with_product,
        {big("max(epoch(date_trunc('second', event_time)))")} AS last_second FROM b_events GROUP BY 1, 2"""),
    "io_parquet_roundtrip": GOLD["sales_daily"],
    "io_document_sink": sql(f"""SELECT o.order_id AS _id, 0 AS part_no, {dbl('net_amount')} AS net_amount,
        strftime(order_date, '%Y-%m-%d') AS order_date, CAST(items_count AS INTEGER) AS n_items,
        {rnd('net_amount', 2)} AS items_revenue FROM s_orders o"""),
    "merge_upsert": sql(f"""SELECT coalesce(t.customer_id, u.customer_id) AS customer_id, coalesce(u.n, t.n) AS n, t.last,
        u.returned_value FROM (SELECT customer_id, count(*) AS n, max(order_date) AS last FROM s_orders
          WHERE status = 'Cancelled' GROUP BY 1) t
        FULL JOIN (SELECT customer_id, count(*) AS n, {dbl('sum(net_amount)')} AS returned_value FROM s_orders
          WHERE status = 'Returned' GROUP BY 1) u ON t.customer_id = u.customer_id"""),
    "export_normalise": sql(f"""SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, {dbl('net_amount')} AS net_amount,
        CASE WHEN device = 'Mobile App' THEN {dbl('net_amount')} END AS odd, strftime(order_date, '%Y-%m-%d') AS dates,
        {dbl('net_amount')} AS nested_v, CASE WHEN device = 'Mobile App' THEN {dbl('net_amount')} END AS nested_w,
        strftime(order_date, '%Y-%m-%d') AS map_d FROM s_orders"""),
    "winback_export": profiles_sql(_WINBACK),
    # ------------------------------------------------------------------ serving
    "sales_trend_day": sql(trend("day", "daily"), DAILY),
    "sales_trend_week": sql(trend("week", "promo"), DAILY_CAT, "promo AS (SELECT * FROM dcat WHERE category = 'PROMO')"),
    "sales_trend_month": sql(trend("month", "daily"), DAILY),
    **{f"sales_trend_buyers_{unit}": sql(f"""SELECT t.*, c.customers FROM ({trend(unit, 'daily')}) t JOIN (
        SELECT CAST(date_trunc('{unit}', order_date) AS DATE) AS p, count(DISTINCT customer_id) AS customers FROM rev
          WHERE order_date BETWEEN {START} AND {END} GROUP BY 1
        UNION ALL SELECT NULL, count(DISTINCT customer_id) FROM rev WHERE order_date BETWEEN {START} AND {END}) c
        ON t.period IS NOT DISTINCT FROM c.p""", DAILY) for unit in ("week", "month")},
    "sales_categories_period": sql(f"""SELECT d.category, {rnd('d.r', 2)} AS revenue, d.units, d.orders, {rnd('d.p', 2)} AS profit,
        coalesce({pct('d.p', 'd.r')}, 0) AS margin_pct, {pct('d.r', '(SELECT sum(revenue) FROM dcat)')} AS share_pct,
        c.return_rate, c.avg_rating, c.avg_discount_pct FROM (
          SELECT category, sum(revenue) AS r, {big('sum(units)')} AS units, {big('sum(orders)')} AS orders, sum(profit) AS p
          FROM dcat GROUP BY 1) d LEFT JOIN {_body('sales_by_category')} c USING (category)""", DAILY_CAT),
    "product_search": sql("""SELECT product_id, product_name, category, units, revenue,
        (SELECT count(*) FROM pstats WHERE contains(lower(product_name), 'ring')) AS total FROM pstats
        WHERE contains(lower(product_name), 'ring') ORDER BY units DESC, product_id LIMIT 25 OFFSET 10""", PSTATS),
    "segment_top_customers": profiles_sql("""SELECT * FROM (SELECT segment, CAST(row_number() OVER (
        PARTITION BY segment ORDER BY total_spent DESC, customer_id) AS INTEGER) AS rank, customer_id, total_spent
        FROM sprofiles) WHERE rank <= 50"""),
    "segment_customers": profiles_sql("""SELECT customer_id, full_name, total_spent FROM sprofiles WHERE segment = 'Champions'
        ORDER BY total_spent DESC, customer_id LIMIT 50"""),
    "churn_by_segment": profiles_sql(f"""SELECT segment, {rnd('avg(churn_probability)', 4)} AS avg_probability,
        count(*) AS customers, {cnt("churn_risk = 'High'")} AS high_risk FROM sprofiles
        WHERE churn_probability IS NOT NULL GROUP BY 1"""),
    "churn_customers": profiles_sql("""SELECT customer_id, full_name, segment, churn_probability, churn_risk, clv_12m, total_spent
        FROM sprofiles WHERE churn_risk = 'High' ORDER BY clv_12m DESC, customer_id LIMIT 50"""),
    "feature_medians": sql(_MEDIAN, CURRENT),
    "recent_purchases": sql("""SELECT customer_id, product_id, product_name, category, CAST(last_ts AS DATE) AS last_ts, rank FROM (
        SELECT customer_id, product_id, min(product_name) AS product_name, min(category) AS category, max(order_ts) AS last_ts,
          CAST(row_number() OVER (PARTITION BY customer_id ORDER BY max(order_ts) DESC, product_id) AS INTEGER) AS rank
        FROM lines WHERE (customer_id, order_id) IN (
          SELECT (customer_id, order_id) FROM (SELECT customer_id, order_id, row_number() OVER (
            PARTITION BY customer_id ORDER BY max(order_ts) DESC, order_id DESC) AS rn
            FROM lines WHERE status <> 'Cancelled' GROUP BY 1, 2) WHERE rn <= 15)
        GROUP BY 1, 2) WHERE rank <= 8"""),
    "rule_search": sql("""SELECT antecedent, consequent, lift FROM prules
        WHERE contains(lower(antecedent), 'brand#1') OR contains(lower(consequent), 'brand#1')
        ORDER BY lift DESC, antecedent, consequent LIMIT 200""", RULES),
    "customer_search": profiles_sql("""SELECT customer_id, full_name, total_spent FROM sprofiles
        WHERE starts_with(CAST(customer_id AS VARCHAR), '1') OR contains(search_name, '1')
        ORDER BY total_spent DESC, customer_id LIMIT 10"""),
    "customer_monthly_spend": sql(f"""SELECT customer_id, order_month AS month, {dbl('sum(net_amount)')} AS revenue,
        count(*) AS orders FROM rev GROUP BY 1, 2"""),
    "customer_category_spend": sql(f"""SELECT customer_id, category, {dbl('sum(revenue)')} AS revenue FROM lines
        WHERE status <> 'Cancelled' GROUP BY 1, 2"""),
    "customer_recent_orders": sql(f"""SELECT customer_id, order_id, order_date, {dbl('net_amount')} AS net_amount, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_ts DESC, order_id DESC) AS INTEGER) AS rank
        FROM s_orders) WHERE rank <= 12"""),
    "customer_actions": rsql("SELECT customer_id, p.segment, action FROM sprofiles p LEFT JOIN actions USING (segment)",
                             *_PROFILE_CTES, _ACTIONS),
    "meta": sql("""SELECT (SELECT d FROM ref_day) AS as_of, min(order_date) AS min_date, max(order_date) AS max_date,
        (SELECT string_agg(DISTINCT category, ',' ORDER BY category) FROM lines) AS categories FROM rev"""),
    "rule_graph_nodes": sql("""SELECT item, count(*) AS n_rules FROM (
        SELECT antecedent AS item FROM prules UNION ALL SELECT consequent FROM prules) GROUP BY 1""", RULES),
    "rule_graph_edges": sql("SELECT antecedent AS src, consequent AS dst, lift, confidence FROM prules", RULES),
    # ------------------------------------------------------------------ features
    "rfm_features": sql("SELECT * FROM rfm", RFM),
    "rfm_scores": sql("SELECT * FROM scores", RFM, SCORES),
    "log_features": sql("SELECT customer_id, " + ", ".join(
        f"{rnd(f'ln(1 + {c})', 6)} AS log_{c}" for c in ("recency_days", "frequency", "monetary", "aov")) + " FROM rfm", RFM),
    "churn_features": sql("SELECT * REPLACE (" + ", ".join(f"{rnd(c, 6)} AS {c}" for c in _ROUND6) + ") FROM training", TRAINING),
    "churn_labels": sql("""SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM rev
        WHERE order_date >= (SELECT d FROM ref_day) - 89) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label FROM training""", TRAINING),
    "interactions": sql("SELECT * FROM strengths", PAIRS),
    "baskets": sql("""SELECT order_id, count(DISTINCT product_id) AS n_items FROM lines WHERE status <> 'Cancelled' GROUP BY 1"""),
    "basket_summary": sql(f"""SELECT count(*) AS baskets, {cnt('n >= 2')} AS multi_item_baskets,
        {pct(cnt('n >= 2'), 'count(*)')} AS multi_item_share_pct
        FROM (SELECT count(DISTINCT product_id) AS n FROM lines WHERE status <> 'Cancelled' GROUP BY order_id)"""),
    "calendar_features": sql("SELECT * FROM cal", SALE_DAYS, "active AS (SELECT DISTINCT order_date AS date FROM rev)",
                             calendar("active", "cal")),
    "daily_series_filled": sql("SELECT * FROM days", DAYS),
    # ------------------------------------------------------------------ segmentation
    "scaled_features": sql(f"SELECT customer_id, {_SCALED} FROM rfm", RFM),
    "segment_profile": rsql(f"""SELECT a.*, action FROM (
        SELECT n.segment, p.cluster, customers, {pct('customers', '(SELECT sum(customers) FROM cprofile)')} AS share_pct,
          {rnd('revenue', 2)} AS revenue, {pct('revenue', '(SELECT sum(revenue) FROM cprofile)')} AS revenue_share_pct,
          {_SEGMENT_COLS} FROM cprofile p JOIN named n USING (cluster)
        UNION ALL SELECT 'Prospects', -1, count(*), NULL, 0.0, 0.0, {', '.join('NULL' for _ in RFM_FEATURES)}
        FROM profiles WHERE orders = 0) a LEFT JOIN actions USING (segment)""",
        PROFILES, RFM, SCORES, CLUSTERED, CLUSTER_PROFILE, NAMES, _ACTIONS),
    # ------------------------------------------------------------------ churn
    "binary_metrics": sql(f"""SELECT tp, fp, fn, tn, {rnd('auc.v', 4)} AS auc, {rnd('aucpr.v', 4)} AS auc_pr,
        {rnd(ratio('tp + tn', 'tp + fp + fn + tn'), 4)} AS accuracy, {rnd(ratio('tp', 'tp + fp'), 4)} AS precision,
        {rnd(ratio('tp', 'tp + fn'), 4)} AS recall,
        {rnd('2 * ' + ratio('tp', 'tp + fp') + ' * ' + ratio('tp', 'tp + fn') + ' / (' + ratio('tp', 'tp + fp') + ' + '
             + ratio('tp', 'tp + fn') + ')', 4)} AS f1 FROM conf, auc, aucpr""", LABELLED, BINARY),
    "roc_curve": sql(f"""SELECT CAST(i AS INTEGER) AS point, {rnd('t', 4)} AS threshold,
        {rnd(ratio('(SELECT count(*) FROM labelled WHERE label <> 1 AND score >= t)', 'n'), 4)} AS fpr,
        {rnd(ratio('(SELECT count(*) FROM labelled WHERE label = 1 AND score >= t)', 'p'), 4)} AS tpr
        FROM (SELECT i, 1 - i / 40.0::DOUBLE AS t FROM range(0, 41) r(i)), pn""", LABELLED),
    "risk_bands": sql(f"""SELECT churn_risk, count(*) AS customers, {rnd('sum(monthly_spend * 12)', 2)} AS revenue_12m
        FROM valued GROUP BY 1""", CURRENT, VALUED),
    "risk_histogram": sql("""SELECT CAST(b AS INTEGER) AS bin, (SELECT count(*) FROM valued
        WHERE least(floor(churn_probability * 10), 9) = b) AS customers FROM range(0, 10) r(b)""", CURRENT, VALUED),
    "clv": sql("SELECT customer_id, churn_probability, churn_risk, clv_12m FROM valued", CURRENT, VALUED),
    "logit_contributions": sql(f"""SELECT customer_id, CAST(driver_no AS INTEGER) AS driver_no, feature, key, contribution FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, no) AS driver_no
        FROM ({_DRIVERS})) WHERE driver_no <= 8""", CURRENT),
    "what_if_scores": sql(f"""SELECT customer_id, scenario, {rnd(_P, 4)} AS probability, {band(_P)} AS risk
        FROM ({_SCENARIO})""", CURRENT),
    # ------------------------------------------------------------------ recommendations
    "holdout_split": sql("SELECT * FROM holdout", HOLDOUT),
    "popularity_baseline": sql("SELECT * FROM poptop", PAIRS, HOLDOUT, POPULAR),
    "topk_excluding_seen": sql("""SELECT * FROM (SELECT customer_id, product_id, strength AS score, CAST(row_number() OVER (
        PARTITION BY customer_id ORDER BY strength DESC, product_id) AS INTEGER) AS rank FROM strengths WHERE buys = 0)
        WHERE rank <= 10""", PAIRS),
    "ranking_metrics": sql(f"""SELECT (SELECT count(*) FROM holdout) AS eval_users, count(*) AS hits,
        coalesce({rnd(ratio('count(*)', '(SELECT count(*) FROM holdout)'), 4)}, 0) AS hit_rate,
        coalesce({rnd(ratio('sum(1 / log2(rank + 1))', '(SELECT count(*) FROM holdout)'), 4)}, 0) AS ndcg
        FROM poptop JOIN holdout USING (customer_id, product_id)""", PAIRS, HOLDOUT, POPULAR),
    "popular_products": sql("""SELECT CAST(row_number() OVER (ORDER BY sold DESC, product_id) AS INTEGER) AS rank, product_id, sold,
        product_name, category, 'Trending best-seller' AS reason FROM (
        SELECT product_id, count(*) AS sold FROM rlines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) JOIN products USING (product_id)"""),
    "similar_items": """SELECT item, similar_item, CAST(rank AS INTEGER) AS rank, CAST(round(sim, 4) AS DOUBLE) AS score FROM (
        SELECT a.vec_id AS item, b.vec_id AS similar_item, sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY sim DESC, b.vec_id) AS rank
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id,
        LATERAL (SELECT CAST(round(CAST(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS DECIMAL(28,10)), 6)
                 AS DECIMAL(18,6)) AS sim)) WHERE rank <= 8""",
    # ------------------------------------------------------------------ baskets
    "pair_rules": sql("SELECT * FROM prules", RULES),
    "bought_together": sql(f"""SELECT antecedent AS product_id, consequent AS companion, CAST(rank AS INTEGER) AS rank, confidence,
        {rnd('lift', 2)} AS lift FROM (SELECT *, row_number() OVER (PARTITION BY antecedent
          ORDER BY confidence DESC, lift DESC, consequent) AS rank FROM prules) WHERE rank <= 5""", RULES),
    # ------------------------------------------------------------------ forecast and anomalies
    "trend_fit": sql(f"""SELECT series, start, {rnd('b', 6)} AS intercept, CAST(round(CAST(a AS DECIMAL(28,8)), 8) AS DOUBLE) AS slope
        FROM h_trend""", DAYS, SALE_DAYS, *hybrid("h", "revenue", "days", "days")),
    "seasonal_effects": sql(f"SELECT series, dow, month, sale_flag, {rnd('effect', 5)} AS effect, days FROM h_eff",
                            DAYS, SALE_DAYS, *hybrid("h", "revenue", "days", "days")),
    "smearing": sql(f"SELECT series, {rnd('smear', 5)} AS smear, {rnd('sigma', 5)} AS sigma FROM h_spread",
                    DAYS, SALE_DAYS, *hybrid("h", "revenue", "days", "days")),
    "baseline_calendar_regression": sql(f"""SELECT t.series, t.date, t.v AS actual, {rnd('exp(list_sum(list_transform(range(1, 22), lambda i: x[i] * b[i]))) - 1', 2)} AS predicted
        FROM designed t JOIN fits USING (series) JOIN edges ON t.date > e""", DAYS, SALE_DAYS, *LEAST_SQUARES).replace("WITH ", "WITH RECURSIVE ", 1),
    "baseline_seasonal_naive": sql("SELECT * FROM naive", DAYS, SPLIT, NAIVE),
    "baseline_moving_average": sql(f"SELECT series, date, actual, {rnd('predicted', 4)} AS predicted FROM average",
                                   DAYS, SPLIT, AVERAGE),
    "forecast_metrics": sql("SELECT series, model, mape, weekly_mape, rmse, mae, r2 FROM dailym JOIN weeklym USING (series, model)",
                            DAYS, SALE_DAYS, SPLIT, NAIVE, AVERAGE, *hybrid("h", "revenue", "past_days", "test_days"),
                            """runs AS (SELECT *, 'naive' AS model FROM naive UNION ALL SELECT *, 'average' FROM average
                            UNION ALL SELECT series, date, revenue, yhat, 'hybrid' FROM h_pred)""", REGRESSION),
    "forecast_intervals": sql(f"""SELECT series, date, {rnd('yhat', 2)} AS yhat,
        {rnd(f'exp(ln(1 + yhat) - {Z80} * sigma) - 1', 2)} AS lo80, {rnd(f'exp(ln(1 + yhat) + {Z80} * sigma) - 1', 2)} AS hi80,
        {rnd(f'exp(ln(1 + yhat) - {Z95} * sigma) - 1', 2)} AS lo95, {rnd(f'exp(ln(1 + yhat) + {Z95} * sigma) - 1', 2)} AS hi95
        FROM h_pred""", DAYS, SALE_DAYS, FUTURE, *hybrid("h", "revenue", "days", "future")),
    "daily_anomalies": sql("SELECT * FROM danom", *ANOMALIES),
    "high_value_orders": sql("SELECT * FROM high", HIGH),
    "return_abuse": sql("SELECT * FROM abuse", ABUSE),
    "high_value_all": sql("SELECT * FROM high", HIGH.replace(" LIMIT 40", "")),
    "return_abuse_all": sql("SELECT * FROM abuse", ABUSE.replace(" LIMIT 40", "")),
    "anomaly_validation": sql(f"""SELECT count(*) AS planted, {cnt('d IN (SELECT date FROM danom)')} AS detected,
        {rnd(ratio(cnt('d IN (SELECT date FROM danom)'), 'count(*)'), 2)} AS recall,
        (SELECT count(DISTINCT date) FROM danom) AS flagged_days FROM truth""", *ANOMALIES,
        "truth(d) AS (VALUES " + ", ".join(f"(DATE '{d}')" for d, _ in TRUTH) + ")"),
    "anomaly_list": sql("""SELECT * FROM (
        SELECT type, series, date, actual, expected, orders, expected_orders, z_score, direction, deviation_pct, severity,
          NULL::BIGINT AS order_id, NULL::BIGINT AS customer_id, NULL::VARCHAR AS payment_method, NULL::BIGINT AS returns,
          NULL::DOUBLE AS return_rate FROM danom
        UNION ALL SELECT type, NULL, date, actual, expected, NULL, NULL, NULL, direction, NULL, severity, order_id, customer_id,
          payment_method, NULL, NULL FROM high
        UNION ALL SELECT type, NULL, NULL, actual, NULL, orders, NULL, NULL, direction, NULL, severity, NULL, customer_id, NULL,
          returns, return_rate FROM abuse)
        ORDER BY date DESC NULLS LAST, type, customer_id NULLS FIRST, order_id NULLS FIRST, series NULLS FIRST LIMIT 200""",
        *ANOMALIES, HIGH, ABUSE),
    # ------------------------------------------------------------------ window primitives
    "win_first_month": sql("SELECT customer_id, min(order_month) AS first_month FROM s_orders GROUP BY 1"),
    "win_mom_lag": sql(f"""SELECT month, {growth('r', 'lag(r) OVER (ORDER BY month)')} AS mom_growth FROM (
        SELECT order_month AS month, {dbl('sum(net_amount)')} AS r FROM rev GROUP BY 1)"""),
    "win_category_rank": sql("SELECT product_id, category, category_rank FROM pstats", PSTATS),
    "win_top1": sql("SELECT customer_id, favourite_category FROM profiles", PROFILES),
    "win_topk": sql("""SELECT category, CAST(rank AS INTEGER) AS rank, product_id FROM (
        SELECT category, product_id, row_number() OVER (PARTITION BY category ORDER BY s.revenue DESC NULLS LAST, product_id) AS rank
        FROM psales s JOIN products USING (product_id)) WHERE rank <= 3""", PSTATS),
    "win_ntile": sql("""SELECT customer_id, CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS tile FROM rfm""", RFM),
}


# --------------------------------------------------------------------- composed entries
ORACLE["forecast_index"] = sql(f"""SELECT m.series, mape, next_30_days, last_30_days FROM dailym m
    JOIN (SELECT series, {rnd('sum(y)', 2)} AS next_30_days FROM (
      SELECT series, {rnd('yhat', 2)} AS y, row_number() OVER (PARTITION BY series ORDER BY date) AS i FROM f_pred) WHERE i <= 30 GROUP BY 1) USING (series)
    JOIN (SELECT series, {rnd('sum(revenue)', 2)} AS last_30_days FROM days, edges WHERE date > last - 30 GROUP BY 1) USING (series)""",
    DAYS, SALE_DAYS, SPLIT, FUTURE, *hybrid("h", "revenue", "past_days", "test_days"), *hybrid("f", "revenue", "days", "future"),
    "runs AS (SELECT series, date, revenue AS actual, yhat AS predicted, 'hybrid' AS model FROM h_pred)", REGRESSION)
ORACLE["anomaly_validation_file"] = ORACLE["anomaly_validation"]
ORACLE["meta_names"] = f"""SELECT m.*, (SELECT string_agg(segment, ',' ORDER BY segment) FROM ({ORACLE['segment_profile']})) AS segments,
    (SELECT string_agg(series, ',' ORDER BY series) FROM (SELECT DISTINCT series FROM ({ORACLE['daily_series_filled']}))) AS forecast_series
    FROM ({ORACLE['meta']}) m"""
ORACLE["sales_last_90_days"] = f"SELECT * FROM ({GOLD['sales_daily']}) WHERE date BETWEEN (SELECT as_of FROM ({GOLD['as_of_date']})) - 89 AND (SELECT as_of FROM ({GOLD['as_of_date']}))"
ORACLE["city_coordinates"] = f"""SELECT c.city, c.lat, c.lon, r.revenue FROM (VALUES {', '.join(f"('{c}', {lat}::DOUBLE, {lon}::DOUBLE)" for c, lat, lon in CITY_COORDINATES)}) c(city, lat, lon)
    LEFT JOIN (SELECT city, revenue FROM ({GOLD['sales_by_city']})) r USING (city)"""


def _long(part: str, text: str, key: str | None, measures: list[str]) -> str:
    named = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in measures)
    name = f"CAST({key} AS VARCHAR)" if key else "'all'"
    return (f"SELECT '{part}' AS part, key, measure, value FROM (UNPIVOT (SELECT {name} AS key, {named} FROM ({text}))"
            f" ON {', '.join(measures)} INTO NAME measure VALUE value)")


_PAGE = {
    "kpis": GOLD["kpis"], "monthly": GOLD["sales_monthly"], "categories": GOLD["sales_by_category"], "top_products": GOLD["top_products"],
    "segments": ORACLE["segment_profile"], "funnel": GOLD["funnel_overall"],
    "anomalies": f"SELECT * FROM ({ORACLE['daily_anomalies']}) ORDER BY date DESC LIMIT 5",
    "forecast": f"SELECT * FROM ({ORACLE['forecast_index']}) WHERE series = '{ALL_SERIES}'", "churn": ORACLE["risk_bands"]}
ORACLE["overview_rows"] = " UNION ALL ".join(_long(part, _PAGE[part], key, measures) for part, (key, measures) in OVERVIEW.items())

RECOMMENDED = f"""known AS (SELECT DISTINCT customer_id, category FROM rlines),
recommended AS (
  SELECT t.customer_id, t.rank, t.product_id, p.product_name, p.category, t.score,
    CASE WHEN k.category IS NOT NULL THEN {quote(REASON_KNOWN)} || p.category ELSE {quote(REASON_GENERIC)} END AS reason
  FROM poptop t JOIN products p USING (product_id) LEFT JOIN known k ON k.customer_id = t.customer_id AND k.category = p.category)"""
ORACLE["recommendation_rows"] = sql("SELECT * FROM recommended", PAIRS, HOLDOUT, POPULAR, RECOMMENDED)
ORACLE["recs_with_fallback_rows"] = sql(f"""SELECT c.customer_id, r.customer_id IS NULL AS fallback, coalesce(r.rank, b.rank) AS rank,
    coalesce(r.product_id, b.product_id) AS product_id, coalesce(r.category, b.category) AS category, coalesce(r.reason, b.reason) AS reason
    FROM customers c LEFT JOIN recommended r USING (customer_id)
    LEFT JOIN (SELECT rank, product_id, category, reason FROM ({ORACLE['popular_products']})) b ON r.customer_id IS NULL""",
    PAIRS, HOLDOUT, POPULAR, RECOMMENDED)
ORACLE["latest_model_metrics"] = f"""SELECT 'document_score' AS model, metric, 'Quality' AS task, 'length score' AS algorithm,
    TIMESTAMP '2024-01-02' AS trained_at, value, true AS is_best FROM (
    UNPIVOT (SELECT {', '.join(f"CAST({m} AS DOUBLE) AS {m}" for m in BINARY_COLUMNS)} FROM ({ORACLE['binary_metrics']}))
    ON {', '.join(BINARY_COLUMNS)} INTO NAME metric VALUE value)"""
ORACLE["customer_segments"] = profiles_sql("""SELECT p.customer_id, coalesce(g.segment, p.segment) AS segment, c.prediction AS cluster, s.R, s.F, s.M, s.score
    FROM profiles p LEFT JOIN segmented g USING (customer_id) LEFT JOIN clustered c USING (customer_id) LEFT JOIN scores s USING (customer_id)""")
