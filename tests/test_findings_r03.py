"""What the third round's findings asked for."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import churn, recommend


def test_churn_summary_lists_are_sorted_in_one_row(spark):
    scores = spark.createDataFrame([("b", 0.7), ("a", 0.6)], "model string, auc double")
    importance = spark.createDataFrame([("f1", 0.1), ("f3", 0.6), ("f2", 0.3), ("f0", 0.3)], "feature string, importance double")
    models = churn.ChurnModels({}, scores, "b", importance.orderBy(F.desc("importance"), "feature"), None, {"regParam": 0.1})
    valued = spark.createDataFrame(
        [(1, 0.95, "High", 10.0), (2, 0.5, "Medium", 5.0), (3, 0.1, "Low", 1.0), (4, 0.9, "High", 2.0)],
        "customer_id int, churn_probability double, churn_risk string, monthly_spend double")
    labelled = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.0)], "customer_id int, label double")
    row = churn.churn_summary(models, labelled, valued, 3).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.training_customers, row.training_churn_rate, row.best_model, row.revenue_at_risk_12m) == (3, 33.33, "b", 144.0)
    assert [m.model for m in row.models] == ["a", "b"]
    assert [(f.feature, f.importance) for f in row.feature_importance] == [("f3", 0.6), ("f0", 0.3), ("f2", 0.3)]
    assert [(b.churn_risk, b.customers) for b in row.risk_distribution] == [("High", 2), ("Low", 1), ("Medium", 1)]
    assert [h.customers for h in row.probability_histogram] == [0, 1, 0, 0, 0, 1, 0, 0, 0, 2]
    assert row.lr_best_params == "regParam=0.1"


def _factors(spark, name, matrix):
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "id int, features array<float>")
    return recommend._factor_rows(frame, name)


def _best_unseen(u, v, seen, k):
    scores = (u.astype(float) @ v.astype(float).T).astype(np.float32)
    return {x: sorted((y for y in range(len(v)) if (x, y) not in seen), key=lambda y: (-scores[x, y], y))[:k] for x in range(len(u))}


@pytest.mark.parametrize("most_seen", [5, 1000])
def test_users_with_long_seen_lists_get_the_same_top_k(spark, most_seen):
    rng = np.random.default_rng(8)
    u, v = rng.random((25, 5)).astype(np.float32), rng.random((120, 5)).astype(np.float32)
    u[4], v[20:40] = 0.0, v[20]
    seen = {(x, y) for x in range(25) for y in rng.choice(120, 3 + 25 * (x % 4 == 0), replace=False).tolist()}
    found = recommend.masked_top_k(
        _factors(spark, "uid", u), _factors(spark, "iid", v), spark.createDataFrame(sorted(seen), "uid int, iid int"), 6, 4, 16, most_seen)
    got = {}
    for r in found.orderBy("uid", "rank").collect():
        got.setdefault(r.uid, []).append(r.iid)
    assert got == _best_unseen(u, v, seen, 6)


def test_no_item_block_is_shuffled_for_another_user_block(spark):
    rng = np.random.default_rng(9)
    u, v = rng.random((64, 8)).astype(np.float32), rng.random((256, 8)).astype(np.float32)
    found = recommend.masked_top_k(_factors(spark, "uid", u), _factors(spark, "iid", v), spark.createDataFrame([(0, 0)], "uid int, iid int"), 5, 4, 16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan and found.count() == 320


def test_the_grid_is_searched_without_a_refit(spark, monkeypatch):
    fits = []
    real = recommend.als
    monkeypatch.setattr(recommend, "als", lambda *a, **kw: fits.append(a) or real(*a, **kw))
    pairs = spark.createDataFrame([(c, p, 1) for c in range(12) for p in range(20) if (c + p) % 3], "customer_id int, product_id int, buys int")
    holdout = spark.createDataFrame([(0, 1), (1, 3)], "customer_id int, product_id int")
    scores = recommend.search_als(pairs.withColumn("strength", F.col("buys") * 5.0), holdout, [(2, 0.1, 1.0), (3, 0.1, 1.0)], 2)[1]
    assert len(fits) == 2 and [g["rank"] for g in scores["grid"]] == [2, 3] and scores["eval_users"] == 2


def test_similar_blocks_meet_without_a_shuffle_and_ties_stay_exact(spark):
    rng = np.random.default_rng(10)
    m = rng.normal(size=(90, 6))
    m[30:60] = m[30]                                            # equal vectors in several blocks
    items = spark.createDataFrame([(f"i{i:02}", [float(x) for x in m[i]]) for i in range(90)], "item string, features array<double>")
    found = recommend.similar_items(items, 5, 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan
    got = {}
    for r in found.collect():
        got.setdefault(int(r.item[1:]), {})[r["rank"]] = int(r.similar_item[1:])
    unit = m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)
    sims = np.round(unit @ unit.T, 6)
    for i in range(90):
        assert [got[i][x] for x in range(1, 6)] == sorted((j for j in range(90) if j != i), key=lambda j: (-sims[i, j], j))[:5]


def test_product_revenue_is_one_grouping_by_product(spark):
    from tradewind.operators import sales

    lines = spark.createDataFrame(
        [(1, 7, "10.10", True), (1, 8, "5.05", True), (1, 8, "5.05", True), (2, 7, "3.00", False), (None, 7, "1.00", True), (3, None, None, True)],
        "product_id int, customer_id int, revenue string, is_revenue boolean").withColumn("revenue", F.col("revenue").cast("decimal(12,2)"))
    found = sales.product_revenue(lines)
    assert {r.product_id: r.revenue for r in found.collect()} == {1: 20.2, 2: None, None: 1.0, 3: None}
    assert "customer_id" not in found._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def _raw(spark):
    """Raw tables with repeated, null and unknown keys."""
    from types import SimpleNamespace

    money = "decimal(12,2)"
    orders = spark.createDataFrame(
        [(1, 7, "2024-01-05 10:00:00", "delivered"), (1, 8, "2024-01-04 10:00:00", "delivered"), (2, 7, "2024-02-01 00:00:00", "Cancelled"),
         (3, None, "2024-02-01 00:00:00", "Delivered"), (4, 99, "2024-03-01 00:00:00", "Returned"), (5, 7, None, "Delivered"), (None, 7, "2024-01-05 10:00:00", "Delivered")],
        "order_id long, customer_id long, order_ts string, status string").selectExpr(
        "order_id", "customer_id", "cast(order_ts as timestamp) order_ts", "status", "'5-LOW' payment_method", "'Desktop' device", "' ' coupon_code",
        f"cast(1 as {money}) shipping_fee")
    items = spark.createDataFrame(
        [(1, 1, 5, 2), (1, 1, 4, 1), (1, 1, 4, 3), (1, 2, 6, 1), (2, 1, 5, 1), (2, None, 5, 1), (2, None, 5, 4), (4, 1, 77, 1), (4, 2, 5, 0),
         (4, 3, 5, 2), (9, 1, 5, 1), (None, 1, 5, 1)], "order_id long, line_no int, product_id long, quantity int").selectExpr(
        "*", f"cast(10 as {money}) list_price", f"cast(9 as {money}) unit_price", "cast(0.1 as decimal(4,2)) discount_pct", "3 rating")
    products = spark.createDataFrame([(4, "a"), (5, "b"), (6, "c"), (6, "d")], "product_id long, category string").selectExpr(
        "product_id", "category product_name", "category", "category sub_category", "category brand", f"cast(10 as {money}) list_price",
        f"cast(4 as {money}) cost_price", "date'2020-01-01' launch_date")
    customers = spark.createDataFrame([(7, "x"), (7, "y"), (8, "x")], "customer_id long, city string").selectExpr(
        "customer_id", "'f' first_name", "'l' last_name", "'e' email", "'Male' gender", "30 age", "city", "city state", "'r' region", "1 city_tier",
        "date'2020-01-01' signup_date", "'Direct' acquisition_channel")
    return SimpleNamespace(orders=orders, order_items=items, products=products, customers=customers)


def _staged(spark, tmp_path):
    from tradewind.plans.silver import Silver, Staged

    plain = Silver(_raw(spark), ["x", "y"], ["5-LOW"])
    return plain, Staged(spark, plain, str(tmp_path / "silver"))


def test_staged_facts_have_the_rows_of_silver(spark, tmp_path):
    plain, staged = _staged(spark, tmp_path)
    for name in ("lines", "orders"):
        was, now = getattr(plain, name), getattr(staged, name)
        assert was.dtypes == now.dtypes
        key = lambda d: sorted(map(str, d.collect()))
        assert key(was) == key(now) and now.count()


def test_staged_facts_are_dealt_by_order_once(spark, tmp_path, monkeypatch):
    from tradewind.plans import silver as plans

    written = {}
    real = plans.write_bucketed

    def write(df, path, partition_by, by, buckets):
        plan = df.repartition(buckets, by)._jdf.queryExecution().executedPlan().toString()
        written[path.rsplit("/", 1)[-1]] = plan.split("Initial Plan")[0]
        return real(df, path, partition_by, by, buckets)

    monkeypatch.setattr(plans, "write_bucketed", write)
    _, staged = _staged(spark, tmp_path)
    staged.orders
    for name, facts in (("lines", 2), ("orders", 1)):        # raw items and orders; raw orders alone
        assert written[name].count("Scan ExistingRDD[order_id") == facts
        assert written[name].count("REPARTITION_BY_NUM") <= facts + 1


def test_orders_look_up_only_what_a_query_uses(spark, tmp_path):
    _, staged = _staged(spark, tmp_path)
    few = staged.orders.groupBy("status").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in few
    assert "Join" in staged.orders.groupBy("city").count()._jdf.queryExecution().optimizedPlan().toString()


def test_independent_tasks_run_at_the_same_time_and_keep_their_order(spark):
    import threading

    from tradewind.sources.scratch import AT_ONCE, at_once

    met = threading.Barrier(AT_ONCE, timeout=60)                 # passed only if all are under way

    def task(i):
        def run():
            met.wait()
            return spark.range(i).count()
        return run

    assert at_once(spark, [task(i) for i in range(AT_ONCE)]) == list(range(AT_ONCE))
    with pytest.raises(ZeroDivisionError):
        at_once(spark, [lambda: 1, lambda: 1 // 0])


def test_registry_trains_all_models_beside_each_other(spark, monkeypatch):
    from types import SimpleNamespace

    from tradewind.plans import training

    begun, given = [], []
    monkeypatch.setattr(training, "at_once", lambda spark, tasks: given.extend(tasks) or [t() for t in tasks])
    for name in ("segmentation", "churn", "recommender", "baskets", "forecast", "anomalies"):
        monkeypatch.setattr(training, f"publish_{name}", lambda *a, name=name: begun.append(name))
    staged = SimpleNamespace(lines=1, orders=1, customers=1, events=1, sessions=1)
    training.publish_all(SimpleNamespace(spark=spark, silver=staged, rfm=1, labelled=1, total_days=1), None, lambda: None)
    assert len(given) == 6 and sorted(begun) == ["anomalies", "baskets", "churn", "forecast", "recommender", "segmentation"]


def test_documents_may_be_written_compressed(spark, tmp_path):
    from tradewind.sources import sinks

    path = str(tmp_path / "docs")
    sinks.write_documents(spark.range(3).withColumn("items", F.array(F.struct(F.col("id").alias("n")))), path, "id", compression="gzip")
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "docs").glob("part-*"))
    assert sorted((r["_id"], r["items"][0].n) for r in spark.read.json(path).collect()) == [(0, 0), (1, 1), (2, 2)]


def test_a_preferred_value_that_nothing_uses_is_not_computed(spark):
    from tradewind.operators.behaviour import preferred_value

    rows = [(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, "x", None), (2, "y", 0), (3, None, 5), (3, "z", 5), (None, "n", 1)]
    found = preferred_value(spark.createDataFrame(rows, "k int, v string, n int"), "k", "v", F.sum("n"), "best")
    assert {r.k: r.best for r in found.collect()} == {1: "a", 2: "y", 3: None, None: "n"}
    unused = spark.range(5).withColumn("k", F.col("id").cast("int")).join(found, "k", "left").select("id")
    assert "Join" not in unused._jdf.queryExecution().optimizedPlan().toString()


def test_orders_staged_without_lines_have_the_same_histories(spark, tmp_path):
    from tradewind.operators import features
    from tradewind.operators.behaviour import preferred_value
    from tradewind.plans.silver import Silver, StagedOrders

    plain = Silver(_raw(spark), ["x", "y"], ["5-LOW"])
    alone = StagedOrders(spark, plain, str(tmp_path / "silver"))
    rows = lambda d: sorted(map(str, d.collect()))
    kept = [c for c in alone.orders.columns if c != "bought"]
    assert rows(alone.orders.select(kept)) == rows(plain.orders.select(kept)) and alone.orders.count()
    assert not (tmp_path / "silver" / "lines").exists()
    with pytest.raises(AttributeError):
        alone.lines
    for found in (
        lambda s: features.rfm_features(s.orders, s.purchases, s.as_of),
        lambda s: preferred_value(s.purchases.filter("is_revenue"), "customer_id", "category", F.sum("revenue"), "best"),
    ):
        assert rows(found(alone)) == rows(found(plain))


def test_the_smallest_row_by_leading_columns_has_the_values_of_the_smallest_row(spark):
    from tradewind.operators import clean

    rows = [(1, 5, 2, "b"), (1, 5, 1, "z"), (1, None, 9, "a"), (2, 7, None, "x"), (2, 7, 3, "a"), (None, 1, 1, "q")]
    df = spark.createDataFrame(rows, "k int, a int, b int, c string")
    found = clean.dedupe(clean.leading(df, ["k"], ["b", "a"]), ["k"])
    assert found.columns == ["k", "a", "b"]
    assert sorted(map(str, found.collect())) == sorted(map(str, clean.dedupe(df, ["k"]).drop("c").collect()))


def test_sessions_without_ids_read_events_once(spark):
    from tradewind.operators import clean, silver

    raw = spark.createDataFrame(
        [(1, 7, "2024-01-01 10:00:00", "purchase"), (2, 7, "2024-01-01 10:10:00", "purchase"), (3, None, "2024-01-01 10:00:00", "purchase"),
         (4, None, "2024-01-01 10:01:00", "checkout"), (4, None, "2024-01-01 10:02:00", "checkout"), (None, None, None, "checkout"),
         (5, 7, "2024-01-03 10:00:00", "checkout")], "event_id long, customer_id long, t string, event_type string").selectExpr(
        "event_id", "customer_id", "cast(t as timestamp) event_time", "event_type", "1L product_id", "'Desktop' device", "'Direct' traffic_source")
    found = silver.sessionise(clean.clean_events(raw), 3600)
    assert found.select("customer_id").distinct().count() == 2
    got = sorted((str(r.customer_id), r.events, r.session_id.startswith("event")) for r in found.collect())
    assert got == [("7", 1, False), ("7", 2, False), ("None", 1, True), ("None", 1, True), ("None", 1, True)]
    assert sorted(r.session_id for r in found.filter("customer_id is null").collect()) == ["event", "event-3", "event-4"]
    logical = found._jdf.queryExecution().optimizedPlan().toString()
    assert "purchase" not in logical.replace("has_purchase", "")      # cleaning is behind the written slots, in no branch


def test_churn_features_find_the_preferred_device_by_a_grouping(spark):
    from tradewind.operators.features import churn_features

    orders = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 2), (2, "c", 1), (2, "c", 2), (2, "a", 3), (3, None, 1)], "customer_id long, device string, d int").selectExpr(
        "customer_id", "device", "date_add(date'2024-01-01', d) order_date", "true is_revenue", "cast(5 as decimal(18,2)) net_amount",
        "cast(1 as decimal(18,2)) discount_amount", "cast(6 as decimal(18,2)) gross_value", "'Delivered' status", "'x' payment_method")
    lines = orders.selectExpr("customer_id", "order_date", "is_revenue", "'cat' category")
    sessions = spark.createDataFrame([], "customer_id long, session_date date, has_cart int, has_purchase int")
    customers = spark.createDataFrame([(1, 30, 1, "Direct")], "customer_id long, age int, city_tier int, acquisition_channel string")
    found = churn_features(orders, lines, sessions, customers, F.lit("2024-02-01").cast("date"))
    assert {r.customer_id: r.preferred_device for r in found.collect()} == {1: "a", 2: "c", 3: "Mobile App"}
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_worker_gives_memory_back_after_each_task(monkeypatch):
    from tradewind.llm import common

    given = []
    monkeypatch.setattr(common, "release", lambda: given.append(1))
    assert list(common.released(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3] and given == [1]
    begun = common.released(lambda batches: (b for b in batches))(iter([1, 2]))
    next(begun)
    begun.close()                                                # a task that is cut short
    assert given == [1, 1]
    assert common.BATCH_BYTES <= 4 << 20
