"""Registered queries over serving, features, models, forecasts, anomalies and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.calendar import last_days, with_calendar_features
from tradewind.functions.exprs import dbl, literal_frame, rnd
from tradewind.operators import (
    anomaly, basket, behaviour, churn, distinct, features, forecast, metrics, ranking, recommend, registry, sales, segment, serve,
)
from tradewind.operators.features import CHURN_NUMERIC
from tradewind.plans.sample import SAMPLE_LOGIT, Sample
from tradewind.plans.silver import write_silver
from tradewind.plans import training
from tradewind.sources import readers, schemas, sinks
from tradewind.sources.model_store import ModelStore
from tradewind.sources.scratch import cut_lineage, scratch_path

PERIOD = ("1998-03-04", "1999-02-17")
PAIR_SUPPORT, PAIR_LIFT = 0.002, 0.9
PRODUCT_SUPPORT = 0.0001
# part of the landing page -> its key column and measures
OVERVIEW = {
    "kpis": (None, ["revenue", "orders", "customers", "aov", "margin_pct", "repeat_customer_rate", "return_rate", "avg_rating"]),
    "monthly": ("month", ["revenue", "orders", "customers", "new_customers", "mom_growth"]),
    "categories": ("category", ["revenue", "orders", "units", "margin_pct", "share_pct"]),
    "top_products": ("product_id", ["revenue", "units"]),
    "segments": ("segment", ["customers", "revenue", "revenue_share_pct"]),
    "funnel": ("step", ["sessions"]),
    "anomalies": ("date", ["actual", "expected", "z_score"]),
    "forecast": ("series", ["next_30_days", "last_30_days"]),
    "churn": ("churn_risk", ["customers", "revenue_12m"]),
}
DAILY_Z, IQR_MULTIPLIER = 2.5, 1.5
SCENARIOS = {
    "baseline": {},
    "lapsed": {"recency_days": 400, "sessions_30d": 0},
    "returner": {"return_rate": 0.9},
    "desktop": {"preferred_device": "Desktop", "cod_share": 1.0},
}
TRUTH = [
    ("1995-06-15", "Payment outage"), ("1996-09-01", "Flash sale"), ("1998-12-24", "Website downtime"),
    ("2000-02-29", "Bulk orders"),
]


# queries that read the silver tables several times
STAGED = {
    "sales_trend_buyers_week", "sales_trend_buyers_month", "daily_anomalies_forest", "model_registry", "churn_summary",
    "churn_importance", "segmentation_curve", "als_grid", "als_recs_with_fallback", "forecast_index", "meta_names", "overview_rows",
    "product_rules", "anomaly_validation_file", "recommendation_rows", "recs_with_fallback_rows",
    "customer_segments", "io_document_sink",
    "winback_export", "segment_top_customers", "segment_customers", "churn_by_segment", "churn_customers",
    "customer_search", "customer_actions", "feature_medians", "recs_with_fallback", "overview", "product_detail",
    "churn_features", "churn_labels", "risk_bands", "risk_histogram", "clv", "logit_contributions", "what_if_scores",
    "segmentation", "segment_profile", "pca_points", "churn_model_metrics", "churn_scores", "popularity_baseline",
    "ranking_metrics", "recommendation_documents", "als_recommendations", "als_similar_products", "anomaly_list",
    "anomaly_validation", "forecast_window", "forecast_forest", "forecast_evaluation", "forecast_intervals",
    "forecast_metrics", "baseline_calendar_regression", "baseline_seasonal_naive", "baseline_moving_average",
    "trend_fit", "high_value_all", "seasonal_effects", "smearing", "daily_anomalies", "rfm_scores", "scaled_features", "win_ntile", "high_value_orders",
}

# of these, the ones on customers' histories, without lines.  Those that fit models stay with the others: a model depends on its rows' order
STAGED_ORDERS = {
    "customer_segments", "winback_export", "segment_top_customers", "segment_customers", "churn_by_segment", "churn_customers",
    "customer_search", "customer_actions", "feature_medians", "churn_features", "churn_labels", "risk_bands", "risk_histogram", "clv",
    "logit_contributions", "what_if_scores", "segment_profile", "rfm_scores", "scaled_features", "win_ntile",
}


# --------------------------------------------------------------------- helpers over the sample
def _scored_documents(s: Sample) -> DataFrame:
    """labels x documents with a deterministic score and label."""
    docs = s.table("documents").select("doc_id", "n_chars")
    score = F.least(F.lit(1.0), F.col("n_chars") / 4000.0)
    return s.table("labels").join(docs, "doc_id").select(
        "doc_id", rnd(score, 4).alias("score"), F.col("quality").alias("label"))


def _days(s: Sample, column: str = "revenue", total_only: bool = False) -> DataFrame:
    """One measure of the gap-free daily series, materialised: the models read it many times."""
    return cut_lineage(forecast.as_value(s.total_days if total_only else s.days, column))


def _pairs(s: Sample) -> DataFrame:
    return features.interactions(s.lines, s.events)


def _popularity(s: Sample):
    """(holdout, candidates, seen) of the popularity baseline."""
    pairs = cut_lineage(_pairs(s))
    holdout = cut_lineage(recommend.holdout_split(s.lines))
    train = recommend.training_pairs(pairs, holdout)
    return holdout, recommend.popular_candidates(train), train.filter("buys > 0")


def _popular_top(s: Sample) -> DataFrame:
    return recommend.popularity_baseline(*_popularity(s))


def _rule_model(s: Sample, level: str = "sub_category", support: float = PAIR_SUPPORT):
    return basket.mine_level(s.lines, level, support)


def _pair_rules(s: Sample) -> DataFrame:
    return basket.pair_rules(_rule_model(s), PAIR_LIFT)


def _rule_docs(s: Sample) -> DataFrame:
    rules = basket.rules_of(_rule_model(s), PAIR_LIFT, None)
    return basket.rule_documents(rules, "sub_category")


def _pair_docs(s: Sample) -> DataFrame:
    """Pair rules shaped as rule documents."""
    return _pair_rules(s).select(
        F.lit("sub_category").alias("level"), F.array("antecedent").alias("antecedent"),
        F.array("consequent").alias("consequent"), "support", "confidence", "lift")


def _items(s: Sample) -> DataFrame:
    return s.table("embeddings").select(
        F.col("vec_id").alias("item"), F.col("embedding").cast("array<double>").alias("features"))


def _metric_inputs(s: Sample) -> DataFrame:
    days = _days(s)
    parts = {
        "hybrid": forecast.hybrid_backtest(days), "naive": forecast.seasonal_naive(days),
        "average": forecast.moving_average(days)}
    return reduce(DataFrame.unionByName, [p.withColumn("model", F.lit(n)) for n, p in parts.items()])


def _forest_evaluation(s: Sample) -> DataFrame:
    days = _days(s)
    return forecast.evaluate(days, forecast.hybrid_backtest(days, forecast.random_forest()))


def _day_anomalies(s: Sample, season: forecast.Seasonality = forecast.calendar_means) -> DataFrame:
    days = cut_lineage(s.total_days)
    money = forecast.fitted_days(forecast.as_value(days, "revenue"), season).select(
        "date", F.col("actual").alias("revenue"), F.col("fitted").alias("expected_revenue"))
    counts = forecast.fitted_days(forecast.as_value(days, "orders"), season).select(
        "series", "date", F.col("actual").alias("orders"), F.col("fitted").alias("expected_orders"))
    return anomaly.daily_anomalies(counts.join(money, "date"), DAILY_Z)


def _feed(s: Sample) -> DataFrame:
    orders = s.orders
    return anomaly.anomaly_feed(
        _day_anomalies(s), anomaly.high_value_orders(orders, IQR_MULTIPLIER, 40), anomaly.return_abuse(orders, n=40))


def _truth(s: Sample) -> DataFrame:
    return literal_frame(s.spark, TRUTH, "date string, reason string").withColumn("date", F.to_date("date"))


def _segmentation(s: Sample):
    return segment.fit_segments(s.rfm)


def _segments(s: Sample) -> DataFrame:
    prospects = s.profiles.filter("orders = 0")
    return segment.segment_profile(s.clustered, prospects)


def _segment_points(s: Sample) -> DataFrame:
    found = _segmentation(s)
    names = cut_lineage(segment.name_clusters(segment.cluster_profile(found.clustered)))
    return segment.pca_points(found.clustered, names)[0]


def _segmentation_rows(s: Sample) -> DataFrame:
    found = _segmentation(s)
    return segment.segment_profile(found.clustered)


def _churn_models(s: Sample):
    return churn.fit_models(s.labelled)


def _churn_scores(s: Sample) -> DataFrame:
    models = _churn_models(s)
    return churn.with_value(churn.score_customers(models.fitted[models.best], s.current_features))


def _als(s: Sample, grid=recommend.ALS_GRID, max_iter: int = 12):
    pairs = _pairs(s)
    model, maps, scores, data = recommend.fit_als(pairs, recommend.holdout_split(s.lines), grid, max_iter)
    return model, maps, scores, data


def _als_recommendations(s: Sample) -> DataFrame:
    model, (umap, imap), _, data = _als(s)
    top = recommend.recommend_unseen(model, umap, umap, imap, data.filter("buys > 0"))
    return recommend.recommendation_documents(recommend.recommendation_rows(top, s.products, s.lines))


def _als_similar(s: Sample) -> DataFrame:
    model, (_, imap), _, _ = _als(s)
    factors = model.itemFactors.join(imap, F.col("id") == F.col("iid")).select(
        F.col("product_id").alias("item"), F.col("features").cast("array<double>").alias("features"))
    return recommend.similar_documents(recommend.similar_items(factors))


def _popularity_documents(s: Sample) -> DataFrame:
    top = _popular_top(s)
    return recommend.recommendation_documents(recommend.recommendation_rows(top, s.products, s.lines))


def _popularity_rows(s: Sample) -> DataFrame:
    """The popularity lists with catalogue fields and reasons, one row per recommendation."""
    rows = recommend.recommendation_rows(_popular_top(s), s.products, s.lines)
    return rows.select("customer_id", "rank", "product_id", "product_name", "category", "score", "reason")


def _fallback_rows(s: Sample) -> DataFrame:
    """Every customer's list with fallback, one row per recommendation."""
    return _with_fallback(s).select("customer_id", "fallback", F.inline("items")).select(
        "customer_id", "fallback", "rank", "product_id", "category", "reason")


def _with_fallback(s: Sample) -> DataFrame:
    return recommend.recs_with_fallback(
        s.customers, _popularity_documents(s), recommend.popular_products(s.lines, s.products))


def _product_detail(s: Sample) -> DataFrame:
    similar = recommend.similar_items(_items(s)).select(
        F.col("item").alias("product_id"), F.col("similar_item").alias("other"), "rank", "score")
    together = basket.bought_together(basket.pair_rules(
        basket.mine(features.basket_items(s.lines, "product_id"), 0.0001), 0.0))
    together = together.withColumnRenamed("companion", "other")
    return serve.product_details(s.stats, similar, together)


def _churn_registry(s: Sample) -> DataFrame:
    scored = _scored_documents(s)
    parts = [
        registry.metric_rows(metrics.binary_metrics(scored), "document_score", "Quality", "length score",
                             F.lit("2024-01-02").cast("timestamp")),
        registry.metric_rows(metrics.binary_metrics(scored, threshold=0.2), "document_score", "Quality", "length score",
                             F.lit("2024-01-01").cast("timestamp"))]
    return registry.latest_metrics(registry.mark_best(parts[0].unionByName(parts[1]), "auc"))


def _model_registry(s: Sample) -> DataFrame:
    """All models trained on the sample, published and read back from their newest versions."""
    store = ModelStore(s.spark, scratch_path(s.spark, "models"))
    training.publish_all(s, store, lambda: _day_anomalies(s, forecast.random_forest()))
    return store.metrics()


def _churn_summary(s: Sample) -> DataFrame:
    models = _churn_models(s)
    scored = churn.with_value(churn.score_customers(models.fitted[models.best], s.current_features))
    return churn.churn_summary(models, s.labelled, cut_lineage(scored))


def _customer_segments(s: Sample) -> DataFrame:
    """Every profile with its segment, cluster and RFM scores; prospects keep theirs."""
    clustered = s.clustered
    names = segment.name_clusters(cut_lineage(segment.cluster_profile(clustered)))
    enriched = segment.customer_segments(
        s.profiles, segment.assign_segments(clustered, names), features.rfm_scores(s.rfm), s.rfm)
    return enriched.select("customer_id", "segment", "cluster", "rfm.R", "rfm.F", "rfm.M", "rfm.score")


def _segment_curve(s: Sample) -> DataFrame:
    found = _segmentation(s)
    return literal_frame(
        s.spark, [(c["k"], c["silhouette"], c["wssse"], c["k"] == found.k) for c in found.curve],
        "k int, silhouette double, wssse double, chosen boolean")


def _als_grid(s: Sample) -> DataFrame:
    scores = recommend.search_als(_pairs(s), recommend.holdout_split(s.lines))[1]
    rows = [("als", g["rank"], g["regParam"], g["alpha"], g["hit_rate"], g["ndcg"], g == scores["best"]) for g in scores["grid"]]
    rows.append(("popularity", None, None, None, scores["popularity_hit_rate"], scores["popularity_ndcg"], False))
    return literal_frame(
        s.spark, rows, "model string, rank int, regParam double, alpha double, hit_rate double, ndcg double, chosen boolean")


def _als_with_fallback(s: Sample) -> DataFrame:
    return recommend.recs_with_fallback(s.customers, _als_recommendations(s), recommend.popular_products(s.lines, s.products))


def _forecast_index(s: Sample) -> DataFrame:
    return forecast.forecast_index(forecast.forecast_documents(_days(s)))


def _meta_names(s: Sample) -> DataFrame:
    row = serve.meta(sales.sales_daily(s.orders), sales.sales_by_category(s.lines, s.orders), s.silver.as_of)
    return serve.with_names(row, _segments(s), s.days.select("series").distinct())


def _overview_rows(s: Sample) -> DataFrame:
    """The nine parts of the landing page."""
    latest = _day_anomalies(s).orderBy(F.desc("date")).limit(5)
    total = _forecast_index(s).filter(F.col("series") == forecast.ALL_SERIES)
    frames = {
        "kpis": sales.kpis(s.orders, s.lines, s.customers), "monthly": sales.sales_monthly(s.orders),
        "categories": sales.sales_by_category(s.lines, s.orders), "top_products": sales.top_products(s.stats),
        "segments": _segments(s), "funnel": behaviour.funnel_steps(behaviour.funnel_base(s.sessions).filter("dimension = 'all'")),
        "anomalies": latest, "forecast": total, "churn": churn.risk_distribution(s.valued)}
    return serve.overview_rows({part: (frames[part], key, measures) for part, (key, measures) in OVERVIEW.items()})


def _product_rules(s: Sample) -> DataFrame:
    """Product rules with names and first categories, and how many itemsets the mining found."""
    column, _ = basket.LEVELS["product"]
    mined = basket.mine(features.basket_items(s.lines, column), PRODUCT_SUPPORT)
    itemsets = mined.freqItemsets.agg(F.count("*").alias("n")).scalar()
    return basket.rule_documents(basket.rules_of(mined, 1.0), "product", s.products).withColumn("itemsets", itemsets)


def _truth_from_file(s: Sample) -> DataFrame:
    """The planted days as the generator leaves them: one JSON object in a file."""
    path = scratch_path(s.spark, "truth")
    days = F.array(*[F.struct(F.lit(d).alias("date"), F.lit(r).alias("reason")) for d, r in TRUTH])
    sinks.write_documents(s.spark.range(1).select(days.alias("planted_anomalies")), path)
    return readers.read_planted_anomalies(s.spark, path)


def _recent_days(s: Sample, days: int = 90) -> DataFrame:
    start, end = last_days(s.silver.as_of, days)
    return serve.between(sales.sales_daily(s.orders), start, end)


# --------------------------------------------------------------------- sources and sinks
def _csv_roundtrip(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "orders-csv")
    sinks.write_csv(s.bronze.orders, path)
    return readers.read_csv(s.spark, path, schemas.ORDERS).withColumn("shipping_fee", dbl("shipping_fee")).withColumn(
        "order_ts", F.unix_timestamp("order_ts"))


def _jsonl_roundtrip(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "products-jsonl")
    sinks.write_documents(s.bronze.products, path)
    return readers.read_json_lines(s.spark, path, schemas.PRODUCTS).withColumns(
        {c: dbl(c) for c in ("list_price", "cost_price")})


def _jsonl_dir(s: Sample) -> DataFrame:
    """Monthly event logs in a directory tree, read back as one frame."""
    path = scratch_path(s.spark, "events-jsonl")
    raw = s.bronze.events.withColumn("event_time", F.date_format("event_time", schemas.TIMESTAMP_FORMAT))
    raw.withColumn("month", F.substring("event_time", 1, 7)).write.partitionBy("month").json(path)
    return readers.read_json_lines(s.spark, f"{path}/*", schemas.EVENTS).groupBy("event_type", "device").agg(
        F.count("*").alias("events"), F.count("product_id").alias("with_product"),
        F.max(F.unix_timestamp("event_time")).alias("last_second"))


def _parquet_roundtrip(s: Sample) -> DataFrame:
    """Silver written to the lake, gold computed from the lake."""
    lake = write_silver(s.spark, s.silver, scratch_path(s.spark, "lake"))
    return sales.sales_daily(lake.orders)


def _document_sink(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "order-documents")
    sinks.write_documents(behaviour.order_documents(s.orders, s.lines), path, "order_id", compression="gzip")
    docs = s.spark.read.schema(
        "_id bigint, part_no int, net_amount double, order_date string, items array<struct<line_no int, revenue double>>"
    ).json(path)
    return docs.select(
        "_id", "part_no", "net_amount", "order_date", F.size("items").alias("n_items"),
        rnd(F.aggregate("items", F.lit(0.0), lambda a, i: a + i["revenue"]), 2).alias("items_revenue"))


def _merge(s: Sample) -> DataFrame:
    by_status = {
        st: s.orders.filter(F.col("status") == st).groupBy("customer_id") for st in ("Cancelled", "Returned")}
    target = by_status["Cancelled"].agg(F.count("*").alias("n"), F.max("order_date").alias("last"))
    updates = by_status["Returned"].agg(F.count("*").alias("n"), dbl(F.sum("net_amount")).alias("returned_value"))
    return sinks.merge_upsert(target, updates, "customer_id")


def _normalised(s: Sample) -> DataFrame:
    odd = F.when(F.col("device") == "Desktop", F.lit(float("nan"))).when(
        F.col("device") == "Mobile Web", F.lit(float("inf"))).otherwise(dbl("net_amount"))
    out = sinks.export_normalise(s.orders.select(
        "order_id", "order_date", "net_amount", odd.alias("odd"),
        F.array("order_date").alias("dates"), F.struct(F.col("net_amount").alias("v"), odd.alias("w")).alias("nested"),
        F.create_map(F.lit("d"), F.col("order_date")).alias("m")))
    return out.select(
        "order_id", "order_date", "net_amount", "odd", F.concat_ws(",", "dates").alias("dates"),
        F.col("nested.v").alias("nested_v"), F.col("nested.w").alias("nested_w"), F.col("m")["d"].alias("map_d"))


def _winback(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "winback")
    export = serve.winback_export(s.scored_profiles, limit=1000)
    sinks.write_csv(export, path)
    return s.spark.read.option("header", True).schema(export.schema).csv(path)


_RATES = [
    "aov", "monetary", "spend_90d", "cart_abandon_rate", "avg_discount_pct", "return_rate", "cancel_rate", "cod_share"]

QUERIES = {
    # ------------------------------------------------------------------ sources and sinks
    "io_csv_roundtrip": _csv_roundtrip,
    "io_jsonl_roundtrip": _jsonl_roundtrip,
    "io_jsonl_dir": _jsonl_dir,
    "io_parquet_roundtrip": _parquet_roundtrip,
    "io_document_sink": _document_sink,
    "merge_upsert": _merge,
    "export_normalise": _normalised,
    "winback_export": _winback,
    # ------------------------------------------------------------------ serving
    "sales_trend_day": lambda s: serve.sales_trend(sales.sales_daily(s.orders), "day", *PERIOD),
    "sales_trend_week": lambda s: serve.sales_trend(
        sales.sales_daily_category(s.lines), "week", *PERIOD, category="PROMO"),
    "sales_trend_month": lambda s: serve.sales_trend(sales.sales_daily(s.orders), "month", *PERIOD),
    "sales_trend_buyers_week": lambda s: _trend_with_buyers(s, "week"),
    "sales_trend_buyers_month": lambda s: _trend_with_buyers(s, "month"),
    "sales_categories_period": lambda s: serve.categories_in_period(
        sales.sales_daily_category(s.lines), sales.sales_by_category(s.lines, s.orders), *PERIOD),
    "product_search": lambda s: serve.search_products(
        s.stats, text="Ring", sort="units", limit=25, skip=10).select(
        "product_id", "product_name", "category", "units", "revenue", "total"),
    "product_detail": _product_detail,
    "segment_top_customers": lambda s: ranking.top_n(
        s.scored_profiles, ["segment"], [F.desc("total_spent"), F.col("customer_id")], 50).select(
        "segment", "rank", "customer_id", "total_spent"),
    "segment_customers": lambda s: segment.segment_customers(s.scored_profiles, "Champions").select(
        "customer_id", "full_name", "total_spent"),
    "churn_by_segment": lambda s: churn.churn_by_segment(s.scored_profiles),
    "churn_customers": lambda s: serve.churn_customers(s.scored_profiles, limit=50).select(
        "customer_id", "full_name", "segment", "churn_probability", "churn_risk", "clv_12m", "total_spent"),
    "feature_medians": lambda s: serve.feature_medians(s.current_features, CHURN_NUMERIC).select(
        "feature", rnd("median", 4).alias("median")),
    "recent_purchases": lambda s: serve.recent_purchases(s.lines).withColumn("last_ts", F.to_date("last_ts")),
    "recs_with_fallback": _with_fallback,
    "rule_search": lambda s: _found_rules(s),
    "forecast_window": lambda s: forecast.forecast_window(
        forecast.forecast_documents(_days(s)), forecast.ALL_SERIES),
    "customer_search": lambda s: serve.search_customers(s.scored_profiles, "1").select(
        "customer_id", "full_name", "total_spent"),
    "customer_monthly_spend": lambda s: serve.customer_monthly_spend(s.orders),
    "customer_category_spend": lambda s: serve.customer_category_spend(s.lines),
    "customer_recent_orders": lambda s: serve.customer_recent_orders(s.orders).select(
        "customer_id", "order_id", "order_date", dbl("net_amount").alias("net_amount"), "rank"),
    "customer_actions": lambda s: serve.customer_actions(s.scored_profiles).select("customer_id", "segment", "action"),
    "meta": lambda s: serve.meta(
        sales.sales_daily(s.orders), sales.sales_by_category(s.lines, s.orders), s.silver.as_of),
    "overview": lambda s: serve.overview(
        sales.kpis(s.orders, s.lines, s.customers), sales.sales_monthly(s.orders), s.stats, _segments(s),
        _day_anomalies(s)),
    "overview_rows": _overview_rows,
    "meta_names": _meta_names,
    "forecast_index": _forecast_index,
    "sales_last_90_days": _recent_days,
    "city_coordinates": lambda s: sales.city_coordinates(s.spark).join(
        sales.sales_by_city(s.orders, sales.city_coordinates(s.spark)).select("city", "revenue"), "city", "left"),
    "rule_graph_nodes": lambda s: basket.graph_nodes(_pair_docs(s)),
    "rule_graph_edges": lambda s: basket.graph_edges(_pair_docs(s)),
    # ------------------------------------------------------------------ features
    "rfm_features": lambda s: s.rfm,
    "rfm_scores": lambda s: features.rfm_scores(s.rfm).select("customer_id", "R", "F", "M", "score"),
    "log_features": lambda s: features.with_logs(s.rfm, features.RFM_LOG).select("customer_id", *[
        rnd(f"log_{c}", 6).alias(f"log_{c}") for c in features.RFM_LOG]),
    "churn_features": lambda s: s.training_features.withColumns({c: rnd(c, 6) for c in _RATES}),
    "churn_labels": lambda s: s.labelled.select("customer_id", "label"),
    "interactions": _pairs,
    "baskets": lambda s: features.basket_items(s.lines, "product_id").groupBy("order_id").agg(
        F.count("*").alias("n_items")),
    "basket_summary": lambda s: features.basket_summary(features.basket_items(s.lines, "product_id")),
    "calendar_features": lambda s: with_calendar_features(sales.sales_daily(s.orders).select("date")),
    "daily_series_filled": lambda s: s.days,
    # ------------------------------------------------------------------ segmentation
    "scaled_features": lambda s: segment.scaled_columns(s.rfm),
    "segmentation": _segmentation_rows,
    "segment_profile": _segments,
    "pca_points": _segment_points,
    "segmentation_curve": _segment_curve,
    "customer_segments": _customer_segments,
    # ------------------------------------------------------------------ churn
    "churn_model_metrics": lambda s: _churn_models(s).scores,
    "churn_summary": _churn_summary,
    "churn_importance": lambda s: _churn_models(s).importance,
    "churn_scores": lambda s: churn.churn_document(_churn_scores(s)),
    "binary_metrics": lambda s: metrics.binary_metrics(_scored_documents(s)),
    "roc_curve": lambda s: metrics.roc_curve(_scored_documents(s)),
    "risk_bands": lambda s: churn.risk_distribution(s.valued),
    "risk_histogram": lambda s: churn.risk_histogram(s.valued),
    "clv": lambda s: s.valued.select("customer_id", "churn_probability", "churn_risk", "clv_12m"),
    "logit_contributions": lambda s: churn.logit_contributions(churn.explain(s.current_features, SAMPLE_LOGIT)),
    "what_if_scores": lambda s: churn.what_if(s.current_features, SCENARIOS, SAMPLE_LOGIT).select(
        "customer_id", "scenario", "probability", "risk"),
    # ------------------------------------------------------------------ recommendations
    "holdout_split": lambda s: recommend.holdout_split(s.lines),
    "popularity_baseline": lambda s: _popular_top(s),
    "topk_excluding_seen": lambda s: recommend.top_k_excluding(
        _touched(s), _pairs(s).filter("buys > 0")).select("customer_id", "product_id", "score", "rank"),
    "ranking_metrics": lambda s: metrics.ranking_metrics(_popular_top(s), recommend.holdout_split(s.lines)),
    "popular_products": lambda s: recommend.popular_products(s.lines, s.products).select(
        "rank", "product_id", "sold", "product_name", "category", "reason"),
    "recommendation_documents": _popularity_documents,
    "recommendation_rows": _popularity_rows,
    "recs_with_fallback_rows": _fallback_rows,
    "als_recommendations": _als_recommendations,
    "als_similar_products": _als_similar,
    "als_grid": _als_grid,
    "als_recs_with_fallback": _als_with_fallback,
    "similar_items": lambda s: recommend.similar_items(_items(s)),
    # ------------------------------------------------------------------ baskets
    "fpgrowth_rules": _rule_docs,
    "product_rules": _product_rules,
    "pair_rules": _pair_rules,
    "bought_together": lambda s: basket.bought_together(_pair_rules(s)),
    # ------------------------------------------------------------------ forecast and anomalies
    "trend_fit": lambda s: forecast.trend_fit(_days(s)).select(
        "series", "start", rnd("intercept", 6).alias("intercept"), rnd("slope", 8).alias("slope")),
    "seasonal_effects": lambda s: _seasonal(s),
    "smearing": lambda s: _smear(s),
    "baseline_seasonal_naive": lambda s: forecast.seasonal_naive(_days(s)),
    "baseline_moving_average": lambda s: forecast.moving_average(_days(s)).withColumn(
        "predicted", rnd("predicted", 4)),
    "baseline_calendar_regression": lambda s: forecast.calendar_regression(_days(s)).withColumn("predicted", rnd("predicted", 2)),
    "forecast_metrics": lambda s: metrics.regression_metrics(_metric_inputs(s), ["series", "model"]),
    "forecast_intervals": lambda s: forecast.forecast_intervals(_days(s)),
    "forecast_forest": lambda s: forecast.forecast_intervals(_days(s), forecast.random_forest()),
    "forecast_evaluation": _forest_evaluation,
    "daily_anomalies": _day_anomalies,
    "daily_anomalies_forest": lambda s: _day_anomalies(s, forecast.random_forest()),
    "high_value_orders": lambda s: anomaly.high_value_orders(s.orders, IQR_MULTIPLIER, 40),
    "high_value_all": lambda s: anomaly.high_value_orders(s.orders, IQR_MULTIPLIER),
    "return_abuse": lambda s: anomaly.return_abuse(s.orders, n=40),
    "return_abuse_all": lambda s: anomaly.return_abuse(s.orders),
    "anomaly_validation": lambda s: anomaly.validate(_day_anomalies(s), _truth(s)),
    "anomaly_validation_file": lambda s: anomaly.validate(_day_anomalies(s), _truth_from_file(s)),
    "anomaly_list": lambda s: anomaly.anomaly_list(_feed(s), n=200),
    "latest_model_metrics": _churn_registry,
    "model_registry": _model_registry,
    # ------------------------------------------------------------------ window primitives
    "win_first_month": lambda s: s.orders.groupBy("customer_id").agg(F.min("order_month").alias("first_month")),
    "win_mom_lag": lambda s: sales.sales_monthly(s.orders).select("month", "mom_growth"),
    "win_category_rank": lambda s: s.stats.select("product_id", "category", "category_rank"),
    "win_top1": lambda s: s.profiles.select("customer_id", "favourite_category"),
    "win_topk": lambda s: ranking.top_n(
        sales.product_revenue(s.lines).join(s.products.select("product_id", "category"), "product_id"),
        ["category"], [F.desc("revenue"), F.col("product_id")], 3).select("category", "rank", "product_id"),
    "win_ntile": lambda s: ranking.with_ntile(cut_lineage(s.rfm), "customer_id", "monetary", 5, "tile"),
}


def _trend_with_buyers(s: Sample, granularity: str) -> DataFrame:
    buyers = distinct.id_words(sales.revenue_only(s.orders).withColumnRenamed("order_date", "date"), ["date"], "customer_id")
    return serve.sales_trend(sales.sales_daily(s.orders), granularity, *PERIOD, buyers=buyers)


def _found_rules(s: Sample) -> DataFrame:
    return basket.search_rules(_pair_docs(s), "sub_category", PAIR_LIFT, "brand#1", 200).select(
        F.col("antecedent")[0].alias("antecedent"), F.col("consequent")[0].alias("consequent"), "lift")


def _touched(s: Sample) -> DataFrame:
    """Scores to rank: every product a customer touched, by interaction strength."""
    return _pairs(s).select("customer_id", "product_id", F.col("strength").alias("score"))


def _fitted(s: Sample):
    days = _days(s)
    base = with_calendar_features(forecast.with_trend(days, forecast.trend_fit(days)))
    return base.withColumn("resid", F.log1p("value") - F.col("trend"))


def _seasonal(s: Sample) -> DataFrame:
    return forecast.seasonal_effects(_fitted(s)).withColumn("effect", rnd("effect", 5))


def _smear(s: Sample) -> DataFrame:
    base = cut_lineage(_fitted(s))
    fitted = forecast.with_yhat(forecast.calendar_means(base)(base))
    return forecast.smearing(fitted).select("series", rnd("smear", 5).alias("smear"), rnd("sigma", 5).alias("sigma"))

