"""Model metrics as aggregates: binary, ranking and regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.exprs import dbl, flag, ratio, rnd
from tradewind.operators.ranking import running_total

ROC_POINTS = 41


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.sum(flag(y & p)).alias("tp"), F.sum(flag(~y & p)).alias("fp"),
        F.sum(flag(y & ~p)).alias("fn"), F.sum(flag(~y & ~p)).alias("tn"))


def _score_distribution(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per score, and of all higher scores; no task sees more than a range of scores."""
    hist = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(flag(F.col(label) == 1)).alias("pos"), F.sum(flag(F.col(label) != 1)).alias("neg"))
    placed = running_total(hist, [F.desc("s")], "pos", "tp_before")
    return running_total(placed, [F.desc("s")], "neg", "fp_before")


def area_under_curves(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """auc_roc by the rank-sum formula (ties count half) and auc_pr by trapezoids, exact for any scores."""
    pts = _score_distribution(df, score, label).withColumns({
        "tp": F.col("tp_before") + F.col("pos"), "fp": F.col("fp_before") + F.col("neg")})
    pts = pts.withColumn("precision", ratio("tp", F.col("tp") + F.col("fp")))
    higher = F.col("tp_before") + F.col("fp_before")
    before = F.when(higher > 0, ratio("tp_before", higher)).otherwise(F.col("precision"))
    # pairs of a positive and a lower negative: all pairs less those with a negative above or beside it
    above = F.col("fp_before") + F.col("neg") / 2
    return pts.agg(
        ratio(F.sum("pos") * F.sum("neg") - F.sum(F.col("pos") * above), F.sum("pos") * dbl(F.sum("neg"))).alias("auc"),
        ratio(F.sum(F.col("pos") * (F.col("precision") + before) / 2), F.sum("pos")).alias("auc_pr"))


def binary_metrics(df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1, area under ROC and PR, in one row."""
    pred = df.withColumn("_pred", flag(F.col(score) > threshold))
    areas = area_under_curves(df, score, label).select(F.struct("auc", "auc_pr")).scalar()
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = F.coalesce(ratio(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(ratio(tp, tp + fn), F.lit(0.0))
    return (
        confusion(pred, label, "_pred")
        .withColumns({"_p": precision, "_r": recall, "_a": areas})
        .select(
            "tp", "fp", "fn", "tn", rnd("_a.auc", 4).alias("auc"), rnd("_a.auc_pr", 4).alias("auc_pr"),
            rnd(ratio(tp + tn, F.greatest(tp + fp + fn + tn, F.lit(1))), 4).alias("accuracy"),
            rnd("_p", 4).alias("precision"), rnd("_r", 4).alias("recall"),
            rnd(F.coalesce(ratio(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r")), F.lit(0.0)), 4).alias("f1"))
    )


def roc_curve(df: DataFrame, score: str = "score", label: str = "label", points: int = ROC_POINTS) -> DataFrame:
    """True/false positive rate at evenly spaced thresholds from 1 to 0 (score >= threshold).

    Every row is counted once, at the first threshold it passes; the curve is a running sum over
    the thresholds, so rows and thresholds never multiply.
    """
    steps = points - 1
    cuts = F.array(*[F.lit(1 - i / steps) for i in range(points)])
    first = F.size(F.filter(cuts, lambda t: t > F.col(score)))
    hits = df.groupBy(first.alias("i")).agg(
        F.sum(flag(F.col(label) == 1)).alias("pos"), F.sum(flag(F.col(label) != 1)).alias("neg"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    full = grid.join(hits, "i", "left").fillna(0)
    upto = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    totals = df.agg(
        F.sum(flag(F.col(label) == 1)).alias("p"), F.sum(flag(F.col(label) != 1)).alias("n")
    ).select(F.struct("p", "n")).scalar()
    return full.select(
        "i", F.element_at(cuts, F.col("i") + 1).alias("threshold"),
        F.sum("pos").over(upto).alias("tp"), F.sum("neg").over(upto).alias("fp"), totals.alias("t"),
    ).select(
        F.col("i").alias("point"), rnd("threshold", 4).alias("threshold"),
        rnd(ratio("fp", F.greatest("t.n", F.lit(1))), 4).alias("fpr"),
        rnd(ratio("tp", F.greatest("t.p", F.lit(1))), 4).alias("tpr"))


def ranking_metrics(ranked: DataFrame, holdout: DataFrame) -> DataFrame:
    """hit_rate and ndcg of (customer, product, rank) lists against one held-out product per customer."""
    keys = ["customer_id", "product_id"]
    n = holdout.agg(F.count("*").alias("n")).scalar()
    gain = 1 / F.log2(F.col("rank") + 1)
    return ranked.join(holdout.select(*keys), keys).agg(
        F.count("*").alias("hits"), F.coalesce(F.sum(gain), F.lit(0.0)).alias("gain")
    ).select(
        n.alias("eval_users"), "hits", F.coalesce(rnd(ratio("hits", n), 4), F.lit(0.0)).alias("hit_rate"),
        F.coalesce(rnd(ratio("gain", n), 4), F.lit(0.0)).alias("ndcg"))


def _week_block(rows: Column, position: Column) -> Column:
    """Block of 7 counted back from the last day; the incomplete first block is null."""
    back = F.floor((rows - 1 - position) / 7)
    return F.when(back < F.floor(rows / 7), back)


def regression_metrics(df: DataFrame, by: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAPE (days with sales only), weekly MAPE, RMSE, MAE, R2 per group of daily rows (`date`)."""
    y, p = F.col(actual), F.col(predicted)
    w = Window.partitionBy(*by)
    placed = df.withColumns({
        "_n": F.count("*").over(w), "_i": F.row_number().over(w.orderBy("date")) - 1, "_mean": F.avg(actual).over(w)})
    daily = placed.groupBy(*by).agg(
        rnd(F.avg(F.when(y > 0, F.abs((y - p) / F.nullif(y, F.lit(0.0))))) * 100, 2).alias("mape"),
        rnd(F.sqrt(F.avg((y - p) * (y - p))), 2).alias("rmse"), rnd(F.avg(F.abs(y - p)), 2).alias("mae"),
        rnd(1 - F.try_divide(F.sum((y - p) * (y - p)), F.sum((y - F.col("_mean")) * (y - F.col("_mean")))), 4).alias("r2"))
    weeks = placed.withColumn("_w", _week_block(F.col("_n"), F.col("_i"))).filter("_w is not null").groupBy(
        *by, "_w").agg(F.sum(actual).alias("wy"), F.sum(predicted).alias("wp"))
    weekly = weeks.groupBy(*by).agg(
        rnd(F.avg(F.try_divide(F.abs(F.col("wy") - F.col("wp")), F.col("wy"))) * 100, 2).alias("weekly_mape"))
    return daily.join(weekly, by, "left").select(*by, "mape", "weekly_mape", "rmse", "mae", "r2")
