"""Date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_spine(df: DataFrame, date_col: str, buffer_days: int = 30) -> DataFrame:
    """One row per day from the earliest date up to, not including, the latest plus ``buffer_days``.

    No day if that is before the earliest date. The scan reads one column and shuffles one (min, max) row per task; an empty input gives no days.
    """
    return days_of(df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")), buffer_days)


def days_of(bounds: DataFrame, buffer_days: int = 30) -> DataFrame:
    """The days of one row (lo, hi), which may come from elsewhere than a scan; NULLs give no days."""
    days = F.sequence(F.col("lo"), F.date_add(F.col("hi"), buffer_days - 1))
    day = F.col("date_day")
    weekend = F.dayofweek(day).isin(1, 7)
    some = F.col("lo") <= F.date_add(F.col("hi"), buffer_days - 1)
    return bounds.filter(some).select(F.explode(days).alias("date_day")).select(
        day,
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_trading_day"),
    )
