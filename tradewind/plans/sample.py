"""The sample data set as silver tables: the input of every registered query."""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import behaviour, churn, features, forecast, sales, segment, silver
from tradewind.operators.churn import LogitModel, LogitTerm
from tradewind.plans.silver import Dealt, Silver, Staged
from tradewind.sources import roles
from tradewind.sources.scratch import cut_lineage, scratch_path

SESSION_GAP_SECONDS = 8 * 3600

# A fixed scoring model, so that everything downstream of a churn score can be checked exactly.
SAMPLE_LOGIT = LogitModel(0.35, (
    LogitTerm("log_recency_days", 5.0, 1.0, 0.9),
    LogitTerm("log_frequency", 2.0, 0.6, -0.5),
    LogitTerm("log_monetary", 13.0, 1.0, -0.3),
    LogitTerm("cart_abandon_rate", 0.5, 0.3, 0.1),
    LogitTerm("return_rate", 0.3, 0.2, 0.25),
    LogitTerm("sessions_30d", 10.0, 8.0, -0.2),
    LogitTerm("cod_share", 0.2, 0.2, 0.15),
    LogitTerm("age", 40.0, 0.0, 0.7),
    LogitTerm("city_tier", 2.0, 0.8, 0.1),
    LogitTerm("preferred_device_ohe_Desktop", 0.33, 0.47, 0.05),
    LogitTerm("acquisition_channel_ohe_BUILDING", 0.2, 0.4, -0.1),
))


class Sample:
    """Lazy view of one sample directory.  `staged` (true, or a kind of Staged) keeps the silver tables a query uses as
    Parquet in the shared folder for the length of that query; Dealt writes nothing."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool | type[Staged] | type[Dealt] = False):
        self.spark, self.sf_dir, self.staged = spark, sf_dir, Staged if staged is True else staged

    def table(self, name: str) -> DataFrame:
        return roles.table(self.spark, self.sf_dir, name)

    @cached_property
    def bronze(self) -> roles.SampleBronze:
        return roles.SampleBronze(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> Silver | Staged:
        tables = Silver(
            self.bronze, roles.city_vocabulary(self.spark, self.sf_dir), roles.PAYMENT_VOCABULARY,
            partial(silver.sessionise, gap_seconds=SESSION_GAP_SECONDS))
        if self.staged is Dealt:
            return Dealt(self.spark, tables)
        return self.staged(self.spark, tables, scratch_path(self.spark, "silver")) if self.staged else tables

    @property
    def customers(self) -> DataFrame:
        return self.silver.customers

    @property
    def products(self) -> DataFrame:
        return self.silver.products

    @property
    def orders(self) -> DataFrame:
        return self.silver.orders

    @property
    def lines(self) -> DataFrame:
        return self.silver.lines

    @property
    def events(self) -> DataFrame:
        return self.silver.events

    @property
    def sessions(self) -> DataFrame:
        return self.silver.sessions

    # ------------------------------------------------------------- features and scores
    @cached_property
    def rfm(self) -> DataFrame:
        return features.rfm_features(self.orders, self.silver.purchases, self.silver.as_of)

    @cached_property
    def clustered(self) -> DataFrame:
        """Buyers with a deterministic cluster (0..4) from their RFM scores."""
        total = F.col("R") + F.col("F") + F.col("M")
        return cut_lineage(features.rfm_scores(self.rfm).withColumn(
            "prediction", F.floor((total - 3) / 3).cast("int")))

    def churn_features(self, as_of, session_as_of) -> DataFrame:
        return features.churn_features(
            self.orders, self.silver.purchases, self.sessions, self.customers, as_of, session_as_of, roles.CASH_ON_DELIVERY)

    @cached_property
    def training_features(self) -> DataFrame:
        return self.churn_features(
            features.churn_cutoff(self.silver.as_of), F.date_add(self.silver.session_as_of, 1))

    @cached_property
    def labelled(self) -> DataFrame:
        return features.churn_labels(
            self.training_features, self.orders, features.churn_cutoff(self.silver.as_of))

    @cached_property
    def current_features(self) -> DataFrame:
        return self.churn_features(F.date_add(self.silver.as_of, 1), F.date_add(self.silver.session_as_of, 1))

    @cached_property
    def valued(self) -> DataFrame:
        """Current features with churn probability (fixed model), band and value."""
        explained = churn.explain(self.current_features, SAMPLE_LOGIT)
        return churn.with_value(explained.withColumnRenamed("probability", "churn_probability"))

    @cached_property
    def profiles(self) -> DataFrame:
        return behaviour.customer_profiles(
            self.orders, self.silver.purchases, self.sessions, self.customers, self.silver.as_of)

    @cached_property
    def scored_profiles(self) -> DataFrame:
        """Profiles with churn score, value and segment, as the serving queries read them."""
        clustered = self.clustered
        named = segment.assign_segments(
            clustered, segment.name_clusters(cut_lineage(segment.cluster_profile(clustered))))
        scores = self.valued.select("customer_id", "churn_probability", "churn_risk", "clv_12m")
        return self.profiles.withColumnRenamed("segment", "_s").join(scores, "customer_id", "left").join(
            named, "customer_id", "left").withColumn("segment", F.coalesce("segment", "_s")).drop("_s")

    # ------------------------------------------------------------- gold inputs of other queries
    @cached_property
    def stats(self) -> DataFrame:
        return sales.product_stats(self.products, self.lines, self.events)

    @cached_property
    def days(self) -> DataFrame:
        return forecast.daily_series(self.orders, self.lines, self.silver.as_of)

    @cached_property
    def total_days(self) -> DataFrame:
        return self.days.filter(F.col("series") == forecast.ALL_SERIES)
