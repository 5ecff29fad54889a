"""Calendar columns and day-level reference frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.vocab import SALE_EVENTS

CALENDAR_FEATURES = [
    "dow", "month", "dom", "is_weekend", "is_salary", "sale_flag", "sale_day", "days_to_month_end",
]


def month_key(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM")


def period_start(unit: str, c: Column | str) -> Column:
    """First day of the day / Monday-based week / month that holds a date."""
    c = F.col(c) if isinstance(c, str) else c
    if unit == "day":
        return c
    if unit not in ("week", "month"):
        raise ValueError(f"granularity must be day, week or month, not {unit!r}")
    return F.to_date(F.date_trunc(unit, c))


def last_days(end: Column, days: int) -> tuple[Column, Column]:
    """Inclusive bounds of the last `days` days up to `end`."""
    return F.date_sub(end, days - 1), end


def sale_days(years: DataFrame, events=SALE_EVENTS) -> DataFrame:
    """One row per day covered by a sale event: (date, event, sale_day).

    `years` has one int column `year`.  The calendar is expanded to days so that
    "is this day inside an event" is an equality join.  Where two events overlap,
    the one listed later wins.
    """
    listed = F.array(*[
        F.struct(
            F.lit(i).alias("pos"), F.lit(name).alias("event"), F.lit(month).alias("m"),
            F.lit(day).alias("d"), F.lit(length).alias("length"),
        )
        for i, (name, month, day, length) in enumerate(events)
    ])
    return (
        years.select("year", F.explode(listed).alias("e"))
        .select("year", "e.*")
        .withColumn("start", F.make_date("year", "m", "d"))
        .withColumn("sale_day", F.explode(F.sequence(F.lit(0), F.col("length") - 1)))
        .select(F.date_add("start", F.col("sale_day")).alias("date"), "year", "pos", "event", "sale_day")
        # an event is looked up by the year of the day itself, so it never spills into January
        .filter(F.year("date") == F.col("year"))
        .groupBy("date")
        .agg(F.max_by(F.struct("event", "sale_day"), "pos").alias("e"))
        .select("date", "e.event", "e.sale_day")
    )


def with_calendar_features(days: DataFrame, date: str = "date", events=SALE_EVENTS) -> DataFrame:
    """Adds day-of-week (0 = Monday), month, day, weekend, salary-week and sale features."""
    years = days.select(F.year(date).alias("year")).distinct()
    sales = sale_days(years, events).select(
        F.col("date").alias("_sale_date"), F.col("sale_day").alias("_sale_day"))
    d = F.col(date)
    return (
        days.join(sales, d == F.col("_sale_date"), "left")
        .withColumn("dow", F.weekday(d))
        .withColumn("month", F.month(d))
        .withColumn("dom", F.dayofmonth(d))
        .withColumn("is_weekend", (F.weekday(d) >= 5).cast("int"))
        .withColumn("is_salary", (F.dayofmonth(d) <= 5).cast("int"))
        .withColumn("sale_flag", F.col("_sale_date").isNotNull().cast("int"))
        .withColumn("sale_day", F.coalesce("_sale_day", F.lit(-1)))
        .withColumn("days_to_month_end", F.datediff(F.add_months(F.trunc(d, "month"), 1), d))
        .drop("_sale_date", "_sale_day")
    )
