"""Ranking, metrics, segments, baskets, recommendations and forecasts against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.functions.calendar import with_calendar_features
from tradewind.operators import (
    anomaly, basket, behaviour, churn, forecast, metrics, ranking, recommend, registry, segment, serve,
)


def days_frame(spark, values, series="s", start=dt.date(2024, 1, 1)):
    data = [(series, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "series string, date date, value double")


# ------------------------------------------------------------------ ranking
@pytest.mark.parametrize("n", [3, 5, 17, 101])
def test_distributed_ntile_equals_the_window(spark, n):
    rng = random.Random(n)
    df = spark.createDataFrame([(i, rng.choice([1, 1, 1, 2, 3, 9])) for i in range(n)], "k int, v int").repartition(6)
    got = {r.k: r.t for r in ranking.with_ntile(df, "k", "v", 5, "t").collect()}
    want = {r.k: r.t for r in df.selectExpr("k", "ntile(5) over (order by v, k) t").collect()}
    assert got == want


def test_running_total_with_weights(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "k int, w int").repartition(9)
    got = {r.k: r.before for r in ranking.running_total(df, [F.col("k")], "w").collect()}
    total = 0
    for i in range(500):
        assert got[i] == total
        total += i % 7


def test_exact_quantiles_and_medians_with_a_hot_value(spark):
    rng = random.Random(1)
    values = [5.0] * 400 + [round(rng.uniform(0, 100), 2) for _ in range(601)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    got = ranking.exact_quantiles(df, "v", {"q1": 0.25, "q2": 0.5, "q3": 0.9}).first()
    assert np.allclose(list(got), np.quantile(values, [0.25, 0.5, 0.9]))
    long = df.withColumn("g", F.lit("a")).unionByName(df.limit(0).withColumn("g", F.lit("b")))
    assert ranking.upper_medians(long, ["g"], "v").collect()[0].median == sorted(values)[len(values) // 2]


def test_rank_within_group_shares_ties(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, rng.choice("aab"), float(rng.randint(0, 20))) for i in range(300)], "k int, g string, v double")
    got = {r.k: r.r for r in ranking.rank_desc_within(df, "g", "v", "r").collect()}
    want = {r.k: r.r for r in df.selectExpr("k", "rank() over (partition by g order by v desc) r").collect()}
    assert got == want


# ------------------------------------------------------------------ metrics
def test_forecast_metrics_of_a_constant_error(spark):
    df = days_frame(spark, [100.0] * 14).withColumnRenamed("value", "actual").withColumn("predicted", F.col("actual") * 1.1)
    m = metrics.regression_metrics(df, ["series"]).first()
    assert math.isclose(m.mape, 10.0) and math.isclose(m.weekly_mape, 10.0)


def test_roc_and_auc_match_brute_force(spark):
    rng = random.Random(3)
    data = [(round(rng.random(), 4), int(rng.random() < 0.3)) for _ in range(400)] + [(0.5, 1), (0.5, 0), (1.0, 1), (0.0, 0)]
    df = spark.createDataFrame(data, "score double, label int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(metrics.area_under_curves(df).first().auc, want, rel_tol=1e-9)
    for r in metrics.roc_curve(df).collect():
        t = 1 - r.point / 40
        assert math.isclose(r.tpr, round(sum(p >= t for p in pos) / len(pos), 4), abs_tol=1e-4)
        assert math.isclose(r.fpr, round(sum(n >= t for n in neg) / len(neg), 4), abs_tol=1e-4)


def test_ranking_metrics(spark):
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 3)], "customer_id int, product_id int, rank int")
    holdout = spark.createDataFrame([(1, 11), (2, 10), (3, 5), (4, 6)], "customer_id int, product_id int")
    m = metrics.ranking_metrics(ranked, holdout).first()
    assert (m.eval_users, m.hits, m.hit_rate) == (4, 2, 0.5)
    assert math.isclose(m.ndcg, round((1 / math.log2(3) + 1 / 2) / 4, 4))


# ------------------------------------------------------------------ calendar
def test_calendar_features(spark):
    df = spark.createDataFrame([(dt.date(2025, 10, 4),), (dt.date(2025, 2, 17),), (dt.date(2025, 12, 31),), (dt.date(2026, 1, 1),)], "date date")
    got = {r.date: r for r in with_calendar_features(df).collect()}
    festive, normal = got[dt.date(2025, 10, 4)], got[dt.date(2025, 2, 17)]
    assert (festive.sale_flag, festive.sale_day) == (1, 1)
    assert (normal.sale_flag, normal.sale_day, normal.dow, normal.is_salary) == (0, -1, 0, 0)
    assert (got[dt.date(2025, 12, 31)].sale_flag, got[dt.date(2025, 12, 31)].days_to_month_end) == (1, 1)
    assert got[dt.date(2026, 1, 1)].sale_flag == 0


# ------------------------------------------------------------------ documents
def test_long_orders_are_split_and_kept_whole(spark):
    lines = spark.range(1, 26).select(
        F.lit("O1").alias("order_id"), F.col("id").cast("int").alias("line_no"),
        *[F.lit(0).alias(c) for c in behaviour.ITEM_FIELDS if c != "line_no"])
    orders = spark.range(1).select(F.lit("O1").alias("order_id"), *[
        F.lit(1).alias(c) for c in behaviour.HEADER_FIELDS if c != "order_id"])
    docs = behaviour.order_documents(orders, lines, per_document=10).orderBy("part_no").collect()
    assert [d.part_no for d in docs] == [0, 1, 2]
    assert [i.line_no for d in docs for i in d["items"]] == list(range(1, 26))


# ------------------------------------------------------------------ segments and churn
def test_cluster_names_are_unique_and_follow_the_rules(spark):
    profile = spark.createDataFrame(
        [(0, 3.0, 30.0, 9.0, 500.0), (1, 2.0, 40.0, 8.0, 600.0), (2, 1.0, 50.0, 2.0, 100.0), (3, 0.0, 200.0, 3.0, 400.0),
         (4, -1.0, 300.0, 5.0, 900.0), (5, -2.0, 500.0, 1.0, 900.0)],
        "cluster int, value double, avg_recency_days double, avg_frequency double, avg_tenure_days double")
    got = {r.cluster: r.segment for r in segment.name_clusters(profile).collect()}
    assert got == {0: "Champions", 1: "Loyal Customers", 2: "New & Promising", 3: "At Risk", 4: "Can't Lose Them", 5: "Hibernating"}


def test_explained_score_adds_up(spark):
    model = churn.LogitModel(0.2, (
        churn.LogitTerm("log_a", 1.0, 2.0, 0.5), churn.LogitTerm("b", 3.0, 0.0, 9.0),
        churn.LogitTerm("c_ohe_x", 0.5, 0.5, -1.0), churn.LogitTerm("d", 1.0, 1.0, 0.1)))
    df = spark.createDataFrame([(1, -4.0, 7.0, "x", 2.0), (2, 10.0, 7.0, "unknown", None)], "customer_id int, a double, b double, c string, d double")
    got = {r.customer_id: r for r in churn.explain(df, model, top=2).collect()}
    for key, a, c, d in ((1, 0.0, 1.0, 2.0), (2, math.log1p(10), 0.0, 0.0)):
        parts = [0.5 * (a - 1) / 2, 0.0, -(c - 0.5) / 0.5, 0.1 * (d - 1)]
        p = 1 / (1 + math.exp(-(0.2 + sum(parts))))
        assert math.isclose(got[key].probability, round(p, 4), abs_tol=1e-4)
        assert [round(abs(x.contribution), 4) for x in got[key].drivers] == sorted((round(abs(x), 4) for x in parts), reverse=True)[:2]
    out = churn.what_if(df, {"base": {}, "swap": {"c": "x"}}, model)
    assert out.count() == 4 and out.filter("scenario = 'swap' and c = 'x'").count() == 2


def test_churn_models_train_and_score(spark):
    from tradewind.operators import features

    rng = random.Random(5)
    rows = []
    for i in range(300):
        recency = rng.randint(1, 400)
        row = [i] + [float(rng.randint(0, 50)) for _ in features.CHURN_NUMERIC] + [rng.choice(["Desktop", "Mobile App"]), "Email"]
        row[1] = float(recency)
        rows.append((*row, float(recency + rng.randint(-60, 60) > 200)))
    cols = ["customer_id int", *[f"{c} double" for c in features.CHURN_NUMERIC],
            *[f"{c} string" for c in features.CHURN_CATEGORICAL], "label double"]
    df = spark.createDataFrame(rows, ", ".join(cols))
    small = churn.ChurnSettings(lr_iterations=10, lr_grid=(0.01,), folds=2, trees=5, forest_depth=3, boost_rounds=3, boost_depth=2)
    models = churn.fit_models(df, small)
    for name, model in models.fitted.items():
        groups = model.transform(features.with_logs(df, features.CHURN_LOG)).schema["raw_features"].metadata["ml_attr"]["attrs"]
        slots = [a["name"] for a in sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])]
        assert churn.slot_names(model) == slots
    assert models.scores.count() == 3 and models.importance.first().feature == "Days since last order"
    scored = churn.with_value(churn.score_customers(models.fitted[models.best], df.drop("label")))
    assert scored.count() == 300 and scored.filter("churn_probability not between 0 and 1").count() == 0
    ours = churn.explain(df.drop("label"), models.logistic).select("customer_id", "probability")
    theirs = churn.score_customers(models.fitted["Logistic Regression"], df.drop("label"))
    gap = ours.join(theirs, "customer_id").agg(F.max(F.abs(F.col("probability") - F.col("churn_probability")))).first()[0]
    assert gap < 2e-3


# ------------------------------------------------------------------ recommendations and baskets
def test_similar_items_across_blocks_match_brute_force(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(60, 8))
    m[7] = m[3]
    items = spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(60)], "item int, features array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    for block_rows in (7, 1000):
        got = {}
        for r in recommend.similar_items(items, k=5, block_rows=block_rows).collect():
            got.setdefault(r.item, {})[r["rank"]] = r.similar_item
        for i in range(60):
            want = sorted((j for j in range(60) if j != i), key=lambda j: (-sims[i, j], j))[:5]
            assert [got[i][k] for k in range(1, 6)] == want


def test_recommendations_are_unseen_and_complete_for_heavy_buyers(spark):
    pairs = [(c, p, 1 + (c + p) % 3) for c in range(12) for p in range(200) if (c + p) % 4 == 0]
    pairs += [(99, p, 1) for p in range(170)]
    df = spark.createDataFrame(pairs, "customer_id int, product_id int, buys int").withColumn("strength", F.col("buys") * 5.0)
    data, umap, imap = recommend.index_pairs(df)
    model = recommend.als(4, 0.1, 5.0, 2).fit(data)
    top = recommend.recommend_unseen(model, umap, umap, imap, df, 10)
    counts = {r.customer_id: r["count"] for r in top.groupBy("customer_id").count().collect()}
    assert len(counts) == 13 and set(counts.values()) == {10}
    assert top.join(df, ["customer_id", "product_id"]).count() == 0


def test_pair_rules_match_brute_force(spark):
    rng = random.Random(4)
    baskets = {o: {rng.choice("abcdef") for _ in range(rng.randint(1, 4))} for o in range(200)}
    items = spark.createDataFrame([(o, i) for o, b in baskets.items() for i in b], "order_id int, item string")
    got = {(r.antecedent, r.consequent): (r.support, r.confidence, r.lift)
           for r in basket.pair_rules(basket.mine(items, 0.05, 0.1), 0.0).collect()}
    n = len(baskets)
    for x in "abcdef":
        for y in "abcdef":
            both = sum(x in b and y in b for b in baskets.values())
            nx, ny = (sum(z in b for b in baskets.values()) for z in (x, y))
            if x == y or both < math.ceil(0.05 * n) or both / nx < 0.1:
                assert (x, y) not in got
            else:
                assert np.allclose(got[x, y], (both / n, both / nx, both / nx / (ny / n)), atol=6e-4)


def test_rule_search_is_literal_and_case_insensitive(spark):
    docs = spark.createDataFrame(
        [("product", ["p.1"], ["p2"], ["Red Pen"], ["Ink"], 2.0), ("product", ["p31"], ["p4"], ["Cup"], ["Mug"], 3.0)],
        "level string, antecedent array<string>, consequent array<string>, antecedent_names array<string>, "
        "consequent_names array<string>, lift double")
    assert [r.lift for r in basket.search_rules(docs, "product", 1.0, "p.1").collect()] == [2.0]
    assert [r.lift for r in basket.search_rules(docs, "product", 1.0, "MUG").collect()] == [3.0]


# ------------------------------------------------------------------ forecast and anomalies
def test_intervals_are_nested_and_days_complete(spark):
    rng = random.Random(6)
    days = days_frame(spark, [100 + 20 * (i % 7) + rng.random() for i in range(200)])
    out = forecast.forecast_intervals(days, horizon=30).collect()
    assert len(out) == 30
    assert all(r.lo95 <= r.lo80 <= r.yhat <= r.hi80 <= r.hi95 for r in out)


def test_seasonal_naive_tiles_the_last_week(spark):
    values = list(range(1, 101))
    got = [r.predicted for r in forecast.seasonal_naive(days_frame(spark, values), 20).orderBy("date").collect()]
    assert got == [float(values[73 + i % 7]) for i in range(20)]


def test_anomaly_of_a_planted_drop(spark):
    days = days_frame(spark, [100 + i % 3 for i in range(60)]).withColumnRenamed("value", "orders")
    days = days.withColumn("orders", F.when(F.col("date") == "2024-02-01", 10.0).otherwise(F.col("orders"))).withColumns(
        {"expected_orders": F.lit(101.0), "revenue": F.lit(1.0), "expected_revenue": F.lit(1.0)})
    found = anomaly.daily_anomalies(days)
    assert [(r.date, r.direction, r.severity) for r in found.collect()] == [(dt.date(2024, 2, 1), "drop", "critical")]
    truth = spark.createDataFrame([(dt.date(2024, 2, 1), "x"), (dt.date(2024, 2, 9), "y")], "date date, reason string")
    v = anomaly.validate(found, truth).first()
    assert (v.planted, v.detected, v.recall, v.flagged_days) == (2, 1, 0.5, 1)


# ------------------------------------------------------------------ serving and registry
def test_trend_totals_and_page(spark):
    daily = spark.createDataFrame(
        [(dt.date(2025, 1, 5) + dt.timedelta(days=i), 10.0, 2, 4, 1.0) for i in range(10)],
        "date date, revenue double, orders int, units int, profit double")
    out = serve.sales_trend(daily, "week", "2025-01-06", "2025-01-12").collect()
    weeks = [r for r in out if not r.is_total]
    assert [(r.period, r.revenue, r.days) for r in weeks] == [(dt.date(2025, 1, 6), 70.0, 7)]
    assert [r.revenue for r in out if r.is_total] == [70.0]


def test_latest_metrics_keep_the_newest(spark):
    one = spark.createDataFrame([(0.5, 3)], "auc double, n int")
    log = registry.metric_rows(one, "m", "t", "a", F.lit("2024-01-01").cast("timestamp")).unionByName(
        registry.metric_rows(one.withColumn("auc", F.lit(0.9)), "m", "t", "a", F.lit("2024-02-01").cast("timestamp")))
    got = {r.metric: r.value for r in registry.latest_metrics(log).collect()}
    assert got == {"auc": 0.9, "n": 3.0}


def test_heavy_buyers_get_full_popularity_lists(spark):
    # customer 1 owns the 145 most popular products of 200, 2 owns 195, 3 all, 4 none
    owned = {1: 145, 2: 195, 3: 200, 4: 0}
    pairs = spark.createDataFrame([(0, p, 1000 - p) for p in range(200)], "customer_id int, product_id int, buys int")
    seen = spark.createDataFrame([(c, p) for c, n in owned.items() for p in range(n)], "customer_id int, product_id int")
    customers = spark.createDataFrame([(c,) for c in owned], "customer_id int")
    rows = recommend.popularity_baseline(customers, recommend.popular_candidates(pairs), seen, 10).collect()
    want = {(c, p, i + 1) for c, n in owned.items() for i, p in enumerate(range(n, min(n + 10, 200)))}
    assert {(r.customer_id, r.product_id, r["rank"]) for r in rows} == want and len(rows) == len(want)


def test_pca_gives_every_customer_a_point(spark):
    from pyspark.ml.linalg import Vectors

    rng = random.Random(3)
    n = 2600
    rows = [(i, Vectors.dense([rng.random(), rng.random(), rng.random()]), i % 2, 1.0, 1, 1) for i in range(n)]
    frame = spark.createDataFrame(rows, ["customer_id", "features", "prediction", "monetary", "frequency", "recency_days"])
    names = spark.createDataFrame([(0, "a"), (1, "b")], "cluster int, segment string")
    assert sorted(r.customer_id for r in segment.pca_points(frame, names)[0].select("customer_id").collect()) == list(range(n))
    assert 0 < segment.pca_points(frame, names, fraction=0.5)[0].count() < n


def _factors(spark, name, matrix):
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "id int, features array<float>")
    return recommend._factor_rows(frame, name)


@pytest.mark.parametrize("blocks", [(7, 10), (64, 256), (5, 1000)])
def test_masked_top_k_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    u = rng.random((40, 6)).astype(np.float32)
    v = (rng.random((90, 6)) * rng.exponential(1, (90, 1))).astype(np.float32)
    v[10], u[3] = v[11], 0.0                                  # ties
    seen = {(x, y) for x in range(40) for y in rng.choice(90, 5, replace=False).tolist()}
    seen |= {(0, y) for y in range(45)} | {(1, y) for y in range(84)} | {(2, y) for y in range(90)}
    found = recommend.masked_top_k(
        _factors(spark, "uid", u), _factors(spark, "iid", v), spark.createDataFrame(sorted(seen), "uid int, iid int"), 8, *blocks)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.uid, {})[r["rank"]] = (r.iid, round(r.score, 5))
    scores = (u.astype(float) @ v.astype(float).T).astype(np.float32)
    for x in range(40):
        open_ = sorted((y for y in range(90) if (x, y) not in seen), key=lambda y: (-scores[x, y], y))[:8]
        assert [i for i, _ in (rows.get(x, {}).get(n + 1, (None, 0)) for n in range(len(open_)))] == open_
        assert len(rows.get(x, {})) == len(open_)


def test_masked_top_k_skips_blocks_by_norm(spark):
    """With falling norms a second pass is asked for by few users only."""
    rng = np.random.default_rng(4)
    u = rng.random((30, 4)).astype(np.float32) + 0.5
    v = ((rng.random((300, 4)) + 0.5) * np.where(np.arange(300) < 60, 10, 0.1)[:, None]).astype(np.float32)
    looked = []
    real = recommend._block_tops
    recommend._block_tops = lambda users, *rest: looked.append(users.count()) or real(users, *rest)
    try:
        found = recommend.masked_top_k(
            _factors(spark, "uid", u), _factors(spark, "iid", v), spark.createDataFrame([(0, i) for i in range(58)], "uid int, iid int"), 5, 8, 50).collect()
    finally:
        recommend._block_tops = real
    assert len(found) == 150
    assert looked[0] == 30 and looked[1] <= 35                # six blocks for all would be 150 more


# ------------------------------------------------------------------ grouped regressions
def _calendar_days(spark, series, n_days, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i, name in enumerate(series):
        level, slope = 4 + i % 5, rng.normal(0, 0.001)
        for d in range(n_days):
            date = dt.date(2023, 5, 3) + dt.timedelta(days=d)
            y = level + slope * d + 0.3 * (date.weekday() >= 5) + 0.05 * date.month + rng.normal(0, 0.1)
            rows.append((name, date, float(np.expm1(y))))
    return spark.createDataFrame(rows, "series string, date date, value double")


@pytest.mark.parametrize("n_days,seen", [(500, True), (75, False)])
def test_calendar_regression_is_least_squares_of_each_series(spark, n_days, seen):
    names = [f"s{i}" for i in range(40)] + [None]
    days = _calendar_days(spark, names, n_days)
    found = {(r.series, r.date): r.predicted for r in forecast.calendar_regression(days, 30).collect()}
    assert len(found) == 30 * len(names) and all(np.isfinite(v) for v in found.values())
    from tradewind.functions.calendar import with_calendar_features

    sale = {r.date: r.sale_flag for r in with_calendar_features(days).select("date", "sale_flag").distinct().collect()}

    def design(date):
        t = (date - dt.date(2023, 5, 3)).days
        return [1, t / 365, *[date.weekday() == d for d in range(1, 7)], *[date.month == m for m in range(2, 13)], date.day <= 5, sale[date]]

    by = {}
    for r in days.orderBy("date").collect():
        by.setdefault(r.series, []).append((r.date, r.value))
    for name, rows in by.items():
        train, test = rows[:-30], rows[-30:]
        x = np.array([design(d) for d, _ in train], float)
        beta = np.linalg.lstsq(x, np.log1p([v for _, v in train]), rcond=None)[0]
        months = {d.month for d, _ in train}
        for d, _ in test:
            if d.month in months:                             # what the data determine is the same for any solution
                assert found[name, d] == pytest.approx(np.expm1(np.array(design(d), float) @ beta), rel=1e-6)
            else:
                assert not seen


def _plain_tree(x, y, depth, least):
    """Best-gain splits by trying every cut of every feature."""
    mean = float(np.mean(y))
    best = (1e-12, None, None)
    if depth:
        for f in range(x.shape[1]):
            for c in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= c
                if left.sum() >= least and (~left).sum() >= least:
                    gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, c)
    if best[1] is None:
        return lambda row: mean
    _, f, c = best
    left = x[:, f] <= c
    low, high = (_plain_tree(x[m], y[m], depth - 1, least) for m in (left, ~left))
    return lambda row: (low if row[f] <= c else high)(row)


def test_forest_tree_equals_exhaustive_search(spark):
    from tradewind.operators.forest import fit_forests, predict_forests

    rng = np.random.default_rng(2)
    rows = [(g, i, int(rng.integers(7)), int(rng.integers(12)), int(rng.integers(2))) for g in ("a", "b") for i in range(90)]
    rows = [(*r, float(r[2] * 1.5 - (r[3] > 6) * 4 + r[4] * r[2] + rng.normal())) for r in rows]
    frame = spark.createDataFrame(rows, "g string, i int, p int, q int, r int, y double")
    features = ["p", "q", "r"]
    forests = fit_forests(frame, "g", "i", features, "y", trees=2, depth=4, min_rows=4, feature_share=1.0, bootstrap=False)
    other = spark.createDataFrame([("c", 0, 1, 1, 1, 0.0)], frame.schema)
    found = {(r.g, r.i): r.out for r in predict_forests(frame.union(other), "g", features, forests, "out").collect()}
    assert found.pop(("c", 0)) is None
    for g in ("a", "b"):
        own = [r for r in rows if r[0] == g]
        x, y = np.array([r[2:5] for r in own], float), np.array([r[5] for r in own])
        tree = _plain_tree(x, y, 4, 4)
        assert all(found[g, r[1]] == pytest.approx(tree(np.array(r[2:5], float)), abs=1e-4) for r in own)


def test_forests_of_forty_series_don_t_depend_on_partitions(spark):
    days = _calendar_days(spark, [f"s{i:02}" for i in range(40)], 150)
    forest = forecast.random_forest(trees=15, depth=4)
    one, many = (
        {(r.series, r.date): r.fitted for r in forecast.fitted_days(days.repartition(n), forest).collect()} for n in (1, 13))
    assert one == pytest.approx(many) and len(one) == 6000
    plain = {(r.series, r.date): r.value for r in days.collect()}
    error = np.mean([abs(np.log1p(one[k]) - np.log1p(v)) for k, v in plain.items()])
    assert error < 0.12                                       # the noise is 0.08 on average, the weekly swing 0.3


def test_pivots_skip_most_pairs_of_clustered_items(spark):
    from tradewind.operators.similarity import similarity_candidates

    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 12))
    m = np.concatenate([c + rng.normal(scale=0.05, size=(50, 12)) for c in centres] + [np.zeros((1, 12)), -centres[:1], centres[:2]])
    items = spark.createDataFrame([(f"i{i:04}", [float(x) for x in row]) for i, row in enumerate(m)], "item string, features array<double>")
    n = len(m)
    compared = similarity_candidates(items, 6, 25).agg(F.sum("compared")).first()[0]
    assert n < compared < 0.25 * n * (n - 1) / 2
    unit = m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)
    sims = np.round(unit @ unit.T, 6)
    got = {}
    for r in recommend.similar_items(items, 6, 25).collect():
        got.setdefault(int(r.item[1:]), {})[r["rank"]] = int(r.similar_item[1:])
    for i in range(n):
        want = sorted((j for j in range(n) if j != i), key=lambda j: (-sims[i, j], j))[:6]
        assert [got[i][x] for x in range(1, 7)] == want
    assert recommend.similar_items(items.limit(0)).count() == 0
    assert recommend.similar_items(items.limit(1)).count() == 0


def test_top_5000_of_a_hot_group_in_two_levels(spark):
    from tradewind.operators.ranking import top_n

    df = spark.range(40_000).selectExpr("case when id < 30000 then 'hot' else concat('g', id % 3) end as g", "id", "(id * 7919) % 1009 as v")
    top = top_n(df, ["g"], [F.desc("v"), F.col("id")], 5000)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number()") == 2 and "hashpartitioning(g" in plan and "_dealt" in plan
    rows = df.collect()
    for g in ("hot", "g0", "g1", "g2"):
        want = sorted((r for r in rows if r.g == g), key=lambda r: (-r.v, r.id))[:5000]
        got = sorted(((r["rank"], r.id) for r in top.filter(F.col("g") == g).collect()))
        assert got == [(i + 1, r.id) for i, r in enumerate(want)]
