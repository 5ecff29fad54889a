"""Ranks, positions, n-tiles and exact quantiles that never sort a whole table in one task.

`running_total` is the core: a range-partitioned sort, one row of totals per range partition, and
an offset per partition.  The per-partition totals are as many as there are shuffle partitions,
so their prefix sum is small whatever the data.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.exprs import col
from tradewind.sources.scratch import cut_lineage

# monotonically_increasing_id() = partition number in the upper bits, row number in the lower 33
_ROW_BITS = 33


GROUP_LIMIT = 1_000   # largest n for which map tasks keep n rows per group before the shuffle


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows per group.  `order` must end in a unique key.

    Up to GROUP_LIMIT rows, map tasks keep at most n rows per group before the shuffle.  Beyond it, two levels do
    it: a group's rows are dealt out to as many parts as there are shuffle partitions, each part keeps its n best, and those
    are merged; so no group reaches one task whole.  Rows are dealt by their own hash, so a recomputed task deals them alike."""
    if n > GROUP_LIMIT:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hashed = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        dealt = df.withColumn("_dealt", F.pmod(F.xxhash64(*hashed), F.lit(parts)))
        within = Window.partitionBy(*by, "_dealt").orderBy(*order)
        df = dealt.withColumn("_place", F.row_number().over(within)).filter(F.col("_place") <= n).drop("_dealt", "_place")
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_1(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return top_n(df, by, order, 1, "_rank").drop("_rank")


def running_total(df: DataFrame, order: list[Column], weight: str | None = None, out: str = "before") -> DataFrame:
    """Adds the sum of `weight` (default: the number of rows) over all rows that sort earlier.

    The sorted frame is materialised once: range bounds are sampled, so evaluating the sort twice
    could cut the partitions differently and the offsets would not fit.
    """
    ordered = cut_lineage(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    amount = F.count("*") if weight is None else F.sum(weight)
    parts = ordered.groupBy("_part").agg(amount.cast("bigint").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    if weight is None:
        local = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    else:
        inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
        local = F.coalesce(F.sum(weight).over(inside), F.lit(0))
    # at most one row per shuffle partition: a proven bound for the broadcast
    return (
        ordered.withColumn("_local", local).join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_part", "_pos", "_local", "_offset")
    )


def ntile_of(position: Column, rows: Column, n: int) -> Column:
    """The n-tile (1..n) of a 0-based position: the first rows % n tiles hold one row more."""
    small = F.floor(rows / n)
    extra = rows % n
    edge = extra * (small + 1)
    return F.when(position < edge, F.floor(position / (small + 1)) + 1).otherwise(
        extra + F.floor((position - edge) / F.greatest(small, F.lit(1))) + 1).cast("int")


def with_ntile(df: DataFrame, key: str, value: str, n: int, out: str) -> DataFrame:
    """(key, out): the n-tile of `value` ascending, ties broken by the key."""
    rows = df.agg(F.count("*").alias("rows")).scalar()
    placed = running_total(df.select(key, value), [F.col(value), F.col(key)])
    return placed.select(key, ntile_of(F.col("before"), rows, n).alias(out))


def distribution(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Distinct values per group with `n`, `before` (rows of the group with a smaller value) and
    `total` (rows of the group)."""
    hist = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    placed = running_total(hist, [F.col(c) for c in [*group, value]], "n", "_all_before")
    if not group:
        total = placed.agg(F.sum("n").alias("total")).scalar()
        return placed.select(value, "n", F.col("_all_before").alias("before"), total.alias("total"))
    starts = placed.groupBy(*[F.col(c).alias(f"_group_{c}") for c in group]).agg(
        F.min("_all_before").alias("_start"), F.sum("n").alias("total"))
    same = reduce(and_, [placed[c].eqNullSafe(starts[f"_group_{c}"]) for c in group])
    return placed.join(starts, same).select(
        *group, value, "n", (F.col("_all_before") - F.col("_start")).alias("before"), "total")


def value_at(position: Column, value: str) -> Column:
    """Aggregate over a distribution: the value of the row at a 0-based position."""
    here = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
    return F.max(F.when(here, F.col(value)))


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float], group: list[str] | None = None) -> DataFrame:
    """Linearly interpolated exact quantiles as columns, over any number of rows."""
    dist = distribution(df, group or [], value)
    picks = []
    for name, p in probabilities.items():
        place = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)
        a, b = value_at(low, value).cast("double"), value_at(high, value).cast("double")
        picks.append((a + (b - a) * F.max(place - low)).alias(name))
    return dist.groupBy(*(group or [])).agg(*picks)


def upper_medians(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The element at index n // 2 of each group's sorted values."""
    return distribution(df, group, value).groupBy(*group).agg(
        value_at(F.floor(F.col("total") / 2), value).alias("median"))


def rank_desc_within(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Competition rank by value descending inside each group; ties share a rank.  A null group is a group; a null
    value has no rank, and its row stays.

    Equal values are one row of the distribution, so neither a big group nor a big tie is sorted
    in one task.
    """
    rows = cut_lineage(df)
    ranks = distribution(rows, [group], value).select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), (F.col("total") - F.col("before") - F.col("n") + 1).cast("int").alias(out))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col(value) == F.col("_value"))
    return rows.join(ranks, same, "left").select(*df.columns, out)


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide doubles to long (keys, name, value)."""
    return df.select(*keys, *[col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, columns, name, value)
