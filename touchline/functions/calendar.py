"""Season and date-dimension expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SEASON_FIRST_MONTH = 8
WEEKEND = (1, 7)  # Spark numbers the week from Sunday = 1


def season_label(day: Column, first_month: int = SEASON_FIRST_MONTH) -> Column:
    """``2023-24`` for any day of the season that starts in ``first_month``.

    Shifting the day back by the months before the season makes the season's first
    year the calendar year of the shifted day, for every century.
    """
    start = F.year(F.add_months(day, 1 - first_month))
    ending = F.lpad(((start + 1) % 100).cast("string"), 2, "0")
    return F.concat(start.cast("string"), F.lit("-"), ending)


def date_key(day: Column) -> Column:
    """The day as the integer yyyyMMdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_attributes(day: Column) -> list[Column]:
    """The 16 columns of the date dimension (I3-I6), in schema order."""
    weekend = F.dayofweek(day).isin(*WEEKEND)
    return [
        date_key(day).alias("date_key"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        weekend.alias("is_weekend"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_name_short"),
        F.date_format(day, "MMM").alias("month_name_short"),
        season_label(day).alias("season"),
        F.when(weekend, "Weekend").otherwise("Weekday").alias("match_day_category"),
    ]


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("lo"), F.lit(last).cast("date").alias("hi")
    )
    return _spread(bounds)


def calendar_covering(df: DataFrame, column: str) -> DataFrame:
    """I1 over the days that ``df`` really holds, found inside the plan.

    The result has one row per day between the extremes, so its size is bounded by the
    date type, not by the number of rows in ``df``.
    """
    bounds = df.agg(
        F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi")
    ).filter("lo IS NOT NULL")
    return _spread(bounds)


def _spread(bounds: DataFrame) -> DataFrame:
    days = bounds.filter("lo <= hi").select(
        F.explode(F.sequence("lo", "hi")).alias("day")
    )
    return days.select(*date_attributes(F.col("day")))
