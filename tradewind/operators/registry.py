"""Model registry: one row per (model, metric), appended per training run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.exprs import dbl


def metric_rows(
    one_row: DataFrame, model: str | Column, task: str, algorithm: str, trained_at: Column | None = None,
) -> DataFrame:
    """Numeric columns of a metrics frame as long rows (model, task, algorithm, trained_at, metric, value)."""
    numeric = [c for c, t in one_row.dtypes if t in ("int", "bigint", "double", "float") or t.startswith("decimal")]
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), dbl(c).alias("value")) for c in numeric])
    name = F.lit(model) if isinstance(model, str) else model
    return one_row.select(
        name.alias("model"), F.lit(task).alias("task"), F.lit(algorithm).alias("algorithm"),
        (trained_at if trained_at is not None else F.current_timestamp()).alias("trained_at"), F.inline(cells))


def mark_best(metrics: DataFrame, metric: str) -> DataFrame:
    """is_best = the model with the largest value of one metric."""
    best = metrics.filter(F.col("metric") == metric).agg(F.max_by("model", F.struct("value", "model")).alias("m")).scalar()
    return metrics.withColumn("is_best", F.col("model") == best)


def latest_metrics(registry: DataFrame) -> DataFrame:
    """The newest value of every model's metrics."""
    return registry.groupBy("model", "metric").agg(F.max_by(
        F.struct(*[c for c in registry.columns if c not in ("model", "metric")]), "trained_at").alias("r")).select(
        "model", "metric", "r.*")
