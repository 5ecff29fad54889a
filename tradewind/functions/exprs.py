"""Small column builders shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.vocab import NON_REVENUE_STATUS

MONEY = "decimal(18,2)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def rnd(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double through a decimal, so that 1.005 gives 1.01 on every engine."""
    return F.round(col(c).cast("decimal(28,8)"), digits).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division as doubles; null when the denominator is null or 0."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return rnd(ratio(num, den) * 100, digits)


def growth_pct(now: Column | str, before: Column | str) -> Column:
    """Percentage change; null when there is no base."""
    return rnd(F.try_divide(dbl(now) - dbl(before), dbl(before)) * 100, 2)


def money_sum(c: Column | str) -> Column:
    """Exact decimal sum, leaving as a double at the edge."""
    return F.sum(col(c)).cast("double")


def when_rev(c: Column | str) -> Column:
    """The value on revenue rows, null elsewhere."""
    return F.when(F.col("is_revenue"), col(c))


def is_revenue(status: Column | str = "status") -> Column:
    return ~col(status).isin(*NON_REVENUE_STATUS)


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (null counts as 0)."""
    return F.when(cond, 1).otherwise(0)


def share_of(cond: Column) -> Column:
    """Unrounded percentage of rows on which a condition holds."""
    return F.avg(flag(cond)) * 100


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def one_row(df: DataFrame) -> Column:
    """A one-row frame as an uncorrelated scalar subquery returning a struct."""
    return df.select(F.struct(*df.columns)).scalar()


def literal_frame(spark, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A fixed reference table, written into the plan as literals (no Python tasks)."""
    names = [p.strip().split(" ")[0] for p in schema.split(",")]
    types = [p.strip().split(" ")[1] for p in schema.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
