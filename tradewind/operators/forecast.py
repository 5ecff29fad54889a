"""Forecasting of many daily series at once: trend, calendar seasonality, backtest, intervals.

Every step is a grouped aggregate over a `series` column, so one job covers the total and all
categories.  Series hold one row per day, whatever the order volume.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.calendar import CALENDAR_FEATURES, with_calendar_features
from tradewind.functions.exprs import dbl, money_sum, rnd
from tradewind.operators.forest import fit_forests, predict_forests
from tradewind.operators.least_squares import least_squares, linear
from tradewind.operators.metrics import regression_metrics
from tradewind.sources.scratch import cut_lineage

ALL_SERIES = "All Categories"
HOLDOUT_DAYS = 60
HORIZON_DAYS = 60
AVERAGE_DAYS = 28
Z80, Z95 = 1.2816, 1.96
SEASON_KEYS = ["dow", "month", "sale_flag"]

# fitted on training days with `resid`; gives a function that adds `season` to any days
Seasonality = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


# ----------------------------------------------------------------- series
def daily_series(orders: DataFrame, lines: DataFrame, as_of: Column) -> DataFrame:
    """(series, date, revenue, orders) without gaps from the first revenue order to `as_of`, for the
    total and for every category; missing days are 0."""
    total = orders.filter("is_revenue").groupBy(F.col("order_date").alias("date")).agg(
        money_sum("net_amount").alias("revenue"), F.count("*").alias("orders"),
    ).withColumn("series", F.lit(ALL_SERIES))
    by_category = lines.filter("is_revenue").groupBy(
        F.col("category").alias("series"), F.col("order_date").alias("date")).agg(
        money_sum("revenue").alias("revenue"), F.countDistinct("order_id").alias("orders"))
    first = total.agg(F.min("date").alias("d")).scalar()
    return fill_days(total.unionByName(by_category), first, as_of, {"revenue": 0.0, "orders": 0})


def fill_days(daily: DataFrame, first: Column, last: Column, defaults: dict) -> DataFrame:
    """Gives every series one row per day in [first, last]: each series unwinds its own date range."""
    spine = daily.select("series").distinct().withColumn("date", F.explode(F.sequence(first, last)))
    known = daily.withColumnsRenamed({"series": "_series", "date": "_date"})
    same = F.col("series").eqNullSafe(F.col("_series")) & (F.col("date") == F.col("_date"))
    return spine.join(known, same, "left").select(
        "series", "date", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in defaults.items()])


def as_value(days: DataFrame, column: str) -> DataFrame:
    return days.select("series", "date", dbl(column).alias("value"))


# ----------------------------------------------------------------- trend
def trend_fit(days: DataFrame) -> DataFrame:
    """Least squares of ln(1 + value) on the day index: (series, start, intercept, slope)."""
    start = F.min("date").over(Window.partitionBy("series"))
    placed = days.withColumn("start", start).withColumn("t", F.datediff("date", "start"))
    y = F.log1p("value")
    return placed.groupBy("series").agg(
        F.min("start").alias("start"), F.regr_intercept(y, F.col("t")).alias("intercept"),
        F.regr_slope(y, F.col("t")).alias("slope"))


def with_trend(days: DataFrame, trend: DataFrame) -> DataFrame:
    """Adds the day index and the trend; the fit has one row per series."""
    return days.join(trend, "series").withColumn("t", F.datediff("date", "start")).withColumn(
        "trend", F.col("intercept") + F.col("slope") * F.col("t")).drop("start", "intercept", "slope")


# ----------------------------------------------------------------- seasonality
def calendar_means(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Mean residual per series and (day of week, month, in-sale); 0 for unseen combinations."""
    effects = seasonal_effects(train).select("series", *SEASON_KEYS, F.col("effect").alias("_e"))

    def add(frame: DataFrame) -> DataFrame:
        return frame.join(effects, ["series", *SEASON_KEYS], "left").withColumn(
            "season", F.coalesce("_e", F.lit(0.0))).drop("_e")

    return add


def seasonal_effects(train: DataFrame) -> DataFrame:
    return train.groupBy("series", *SEASON_KEYS).agg(F.avg("resid").alias("effect"), F.count("*").alias("days"))


def random_forest(trees: int = 120, depth: int = 7, seed: int = 42) -> Seasonality:
    """A forest per series on the calendar features."""

    def fit(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
        forests = cut_lineage(fit_forests(train, "series", "date", CALENDAR_FEATURES, "resid", trees, depth, seed=seed))
        return lambda frame: predict_forests(frame, "series", CALENDAR_FEATURES, forests, "season")

    return fit


# ----------------------------------------------------------------- hybrid model
@dataclass(frozen=True)
class HybridModel:
    """Trend plus seasonality, fitted for all series at once."""

    trend: DataFrame                             # one row per series
    add_season: Callable[[DataFrame], DataFrame]
    spread: DataFrame                            # smear and sigma per series

    def predict(self, frame: DataFrame) -> DataFrame:
        """Adds `yhat` (back-transformed, at least 0, times the smearing factor), `sigma` and `smear`."""
        days = self.add_season(with_calendar_features(with_trend(frame, self.trend)))
        return with_yhat(days).join(self.spread, "series").withColumn("yhat", F.col("yhat") * F.col("smear"))


def hybrid_fit(train: DataFrame, season: Seasonality = calendar_means) -> HybridModel:
    """Fits on `train` (series, date, value); the residual spread comes from the same days."""
    trend = cut_lineage(trend_fit(train))
    base = cut_lineage(with_calendar_features(with_trend(train, trend)))
    add_season = season(base.withColumn("resid", F.log1p("value") - F.col("trend")))
    return HybridModel(trend, add_season, cut_lineage(smearing(with_yhat(add_season(base)))))


def hybrid_predict(train: DataFrame, frame: DataFrame, season: Seasonality = calendar_means) -> DataFrame:
    return hybrid_fit(train, season).predict(frame)


def with_yhat(df: DataFrame) -> DataFrame:
    return df.withColumn("yhat", F.greatest(F.expm1(F.col("trend") + F.col("season")), F.lit(0.0)))


def smearing(fitted: DataFrame) -> DataFrame:
    """Per series: smear = mean exp(residual) (Duan) and sigma = population deviation of residuals."""
    resid = F.log1p("value") - F.log1p("yhat")
    return fitted.groupBy("series").agg(F.avg(F.exp(resid)).alias("smear"), F.stddev_pop(resid).alias("sigma"))


# ----------------------------------------------------------------- backtest
def split_days(days: DataFrame, holdout: int = HOLDOUT_DAYS) -> tuple[DataFrame, DataFrame]:
    """The last `holdout` days of the table are the test part."""
    edge = days.agg(F.date_sub(F.max("date"), holdout).alias("d")).scalar()
    return days.filter(F.col("date") <= edge), days.filter(F.col("date") > edge)


def seasonal_naive(days: DataFrame, holdout: int = HOLDOUT_DAYS) -> DataFrame:
    """The last training week repeated: an equality join on the source date."""
    train, test = split_days(days, holdout)
    last = train.agg(F.max("date").alias("d")).scalar()
    source = F.date_add(last, F.pmod(F.datediff("date", last) - 1, F.lit(7)) - 6)
    week = train.select("series", F.col("date").alias("_src"), F.col("value").alias("predicted"))
    return test.withColumn("_src", source).join(week, ["series", "_src"]).select(
        "series", "date", F.col("value").alias("actual"), "predicted")


def moving_average(days: DataFrame, holdout: int = HOLDOUT_DAYS, window: int = AVERAGE_DAYS) -> DataFrame:
    train, test = split_days(days, holdout)
    last = train.agg(F.max("date").alias("d")).scalar()
    mean = train.filter(F.col("date") > F.date_sub(last, window)).groupBy("series").agg(
        F.avg("value").alias("predicted"))
    return test.join(mean, "series").select("series", "date", F.col("value").alias("actual"), "predicted")


def calendar_design() -> list[Column]:
    """Level, years since the start, day of week, month, salary week and sale."""
    levels = [F.col("dow") == d for d in range(1, 7)] + [F.col("month") == m for m in range(2, 13)]
    return [F.lit(1.0), F.col("t") / 365.0, *[c.cast("double") for c in levels], dbl("is_salary"), dbl("sale_flag")]


def calendar_regression(days: DataFrame, holdout: int = HOLDOUT_DAYS) -> DataFrame:
    """Linear regression of ln(1 + value) on the calendar design, one fit per series.  Days of the week and months without training
    days have no effect of their own."""
    start = F.min("date").over(Window.partitionBy("series"))
    placed = cut_lineage(with_calendar_features(days.withColumn("t", dbl(F.datediff("date", start)))))
    train, test = split_days(placed, holdout)
    fits = least_squares(train, "series", calendar_design(), F.log1p("value")).withColumnRenamed("series", "_series")
    return test.join(fits, F.col("series").eqNullSafe(F.col("_series"))).select(
        "series", "date", F.col("value").alias("actual"), F.expm1(linear(calendar_design())).alias("predicted"))


def hybrid_backtest(days: DataFrame, season: Seasonality = calendar_means, holdout: int = HOLDOUT_DAYS) -> DataFrame:
    train, test = split_days(days, holdout)
    return hybrid_predict(train, test, season).select(
        "series", "date", F.col("value").alias("actual"), F.col("yhat").alias("predicted"))


def evaluate(days: DataFrame, hybrid: DataFrame | None = None, holdout: int = HOLDOUT_DAYS) -> DataFrame:
    """(series, model, mape, weekly_mape, rmse, mae, r2) of the hybrid and the three baselines."""
    runs = {
        "Hybrid trend + seasonality": hybrid_backtest(days, calendar_means, holdout) if hybrid is None else hybrid,
        "Calendar Linear Regression": calendar_regression(days, holdout),
        "Seasonal Naive (last week)": seasonal_naive(days, holdout),
        "28-day Moving Average": moving_average(days, holdout),
    }
    stacked = None
    for name, run in runs.items():
        part = run.withColumn("model", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part)
    return regression_metrics(stacked, ["series", "model"])


# ----------------------------------------------------------------- forecast
def future_days(days: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    return days.groupBy("series").agg(F.max("date").alias("last")).select(
        "series", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))).alias("date"))


def forecast_intervals(days: DataFrame, season: Seasonality = calendar_means, horizon: int = HORIZON_DAYS) -> DataFrame:
    """(series, date, yhat, lo80, hi80, lo95, hi95) for the next `horizon` days."""
    return with_intervals(hybrid_predict(days, future_days(days, horizon), season))


def with_intervals(pred: DataFrame) -> DataFrame:
    def band(z: float) -> Column:
        return rnd(F.expm1(F.log1p("yhat") + F.lit(z) * F.col("sigma")), 2)

    return pred.select(
        "series", "date", rnd("yhat", 2).alias("yhat"), band(-Z80).alias("lo80"), band(Z80).alias("hi80"),
        band(-Z95).alias("lo95"), band(Z95).alias("hi95"))


def fitted_days(days: DataFrame, season: Seasonality = calendar_means) -> DataFrame:
    """History with the smeared fit: (series, date, actual, fitted)."""
    return hybrid_predict(days, days, season).select(
        "series", "date", F.col("value").alias("actual"), F.col("yhat").alias("fitted"))


def forecast_documents(
    days: DataFrame, season: Seasonality = calendar_means, holdout: int = HOLDOUT_DAYS, horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """One row per series: history[], holdout[], forecast[], evaluation[], next/last 30-day sums."""
    days = cut_lineage(days)

    def nested(df, fields, name):
        return df.groupBy("series").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))

    model = hybrid_fit(days, season)
    history = model.predict(days).select(
        "series", "date", rnd("value", 2).alias("actual"), rnd("yhat", 2).alias("fitted"))
    backtest = cut_lineage(hybrid_backtest(days, season, holdout))
    held = backtest.select("series", "date", rnd("actual", 2).alias("actual"), rnd("predicted", 2).alias("predicted"))
    ahead = cut_lineage(with_intervals(model.predict(future_days(days, horizon))))
    first = F.min("date").over(Window.partitionBy("series"))
    near = ahead.withColumn("_f", first).filter(F.datediff("date", "_f") < 30).groupBy("series").agg(
        rnd(F.sum("yhat"), 2).alias("next_30_days"))
    last = F.max("date").over(Window.partitionBy("series"))
    recent = days.withColumn("_l", last).filter(F.datediff("_l", "date") < 30).groupBy("series").agg(
        rnd(F.sum("value"), 2).alias("last_30_days"))
    out = nested(history, ["date", "actual", "fitted"], "history")
    for part in (
        nested(held, ["date", "actual", "predicted"], "holdout"),
        nested(ahead, ["date", "yhat", "lo80", "hi80", "lo95", "hi95"], "forecast"),
        nested(evaluate(days, backtest, holdout), ["model", "mape", "weekly_mape", "rmse", "mae", "r2"], "evaluation"),
        near, recent,
    ):
        out = out.join(part, "series")
    return out


def forecast_window(documents: DataFrame, series: str, history_days: int = 240) -> DataFrame:
    """One series with the last `history_days` points of its history."""
    start = F.greatest(F.size("history") - history_days, F.lit(0)) + 1
    return documents.filter(F.col("series") == series).withColumn(
        "history", F.slice("history", start, F.lit(history_days)))


def forecast_index(documents: DataFrame) -> DataFrame:
    """One line per series: error of the hybrid model, next and last 30 days."""
    hybrid = F.filter("evaluation", lambda e: e["model"].startswith("Hybrid"))
    return documents.select("series", hybrid[0]["mape"].alias("mape"), "next_30_days", "last_30_days")
