"""Times the pipeline stages and headline queries; prints one JSON line.

The stages follow a nightly run: silver is cleaned, joined and written once as Parquet, then
every stage reads it from there.  The headline queries start from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tradewind.operators import anomaly, basket, behaviour, churn, forecast, recommend, sales, segment  # noqa: E402
from tradewind.operators.features import basket_items, churn_cutoff, churn_labels, interactions  # noqa: E402
from tradewind.plans import registry  # noqa: E402
from tradewind.plans.sample import Sample  # noqa: E402
from tradewind.plans.silver import TABLES  # noqa: E402
from tradewind.sources.scratch import cut_lineage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "sales_monthly", "sales_daily_category", "product_stats", "customer_profiles", "cohort_retention",
    "campaign_uplift", "funnel_by_dimension", "pair_rules", "similar_items", "high_value_orders",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("tradewind-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tradewind-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stage_silver(s: Sample) -> None:
    for name in TABLES:
        getattr(s.silver, name)


def stage_gold(s: Sample) -> None:
    for df in (
        sales.kpi_document(s.orders, s.lines, s.customers, s.sessions, s.silver.as_of), sales.sales_daily(s.orders),
        sales.sales_daily_category(s.lines), sales.sales_monthly(s.orders), sales.sales_by_category(s.lines, s.orders),
        sales.sales_by_subcategory(s.lines), sales.sales_by_state(s.orders), sales.sales_dimensions(s.orders, s.customers),
        sales.sales_heatmap(s.orders), sales.campaign_uplift(s.orders), s.stats,
        behaviour.funnel_documents(behaviour.funnel_base(s.sessions)), behaviour.traffic_hourly(s.sessions),
        behaviour.traffic_monthly(s.sessions), behaviour.event_counts(s.events),
        behaviour.cohort_documents(behaviour.cohort_retention(s.orders)),
    ):
        run(df)


def stage_order_documents(s: Sample) -> None:
    run(behaviour.order_documents(s.orders, s.lines))


def stage_profiles(s: Sample) -> None:
    run(s.profiles)


def stage_segmentation(s: Sample) -> None:
    run(segment.segment_profile(segment.fit_segments(s.rfm).clustered))


def stage_churn(s: Sample) -> None:
    labelled = churn_labels(s.training_features, s.orders, churn_cutoff(s.silver.as_of))
    models = churn.fit_models(labelled)
    run(churn.churn_document(churn.with_value(churn.score_customers(models.fitted[models.best], s.current_features))))


def stage_recommendations(s: Sample) -> None:
    pairs = interactions(s.lines, s.events)
    model, (umap, imap), _, data = recommend.fit_als(pairs, recommend.holdout_split(s.lines))
    top = recommend.recommend_unseen(model, umap, umap, imap, data.filter("buys > 0"))
    run(recommend.recommendation_documents(recommend.recommendation_rows(top, s.products, s.lines)))


def stage_baskets(s: Sample) -> None:
    for column, support in basket.LEVELS.values():
        run(basket.rules_of(basket.mine(basket_items(s.lines, column), support), 1.0))


def stage_forecast(s: Sample) -> None:
    days = cut_lineage(forecast.as_value(s.days, "revenue"))
    run(forecast.forecast_documents(days, forecast.random_forest()))
    run(anomaly.high_value_orders(s.orders))
    run(anomaly.return_abuse(s.orders))


STAGES = {
    "stage_silver": stage_silver, "stage_gold_tables": stage_gold, "stage_order_documents": stage_order_documents,
    "stage_customer_360": stage_profiles, "stage_segmentation": stage_segmentation, "stage_churn": stage_churn,
    "stage_recommendations": stage_recommendations, "stage_baskets": stage_baskets, "stage_forecast": stage_forecast,
}


def main() -> None:
    spark = session()
    wanted = sys.argv[1:]
    times: dict[str, float] = {}

    def timed(name, work):
        if wanted and name not in wanted and name != "stage_silver":
            return
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    spark.range(1000).selectExpr("sum(id)").collect()      # JVM start-up is not a query
    sample = Sample(spark, SF_DIR, staged=True)
    for name, work in STAGES.items():
        timed(name, lambda work=work: work(sample))
    queries = registry.queries()
    for name in HEADLINE:
        timed(name, lambda name=name: run(queries[name](spark, SF_DIR)))
    print(json.dumps({
        "metric": "pipeline stages and headline queries, total wall time", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
