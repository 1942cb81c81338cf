"""Contiguous calendars built on the executors from one-row bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.keys import date_key


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One ``full_date`` row per day of the one-row ``bounds`` frame (empty when a bound is NULL)."""
    return bounds.where(F.col(first).isNotNull() & F.col(last).isNotNull()).select(
        F.explode(F.sequence(first, last)).alias("full_date")
    )


def describe_days(days: DataFrame) -> DataFrame:
    """The day attributes of the warehouse calendar."""
    day = F.col("full_date")
    iso_day = (F.weekday(day) + 1).cast("smallint")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        iso_day.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        F.dayofyear(day).cast("smallint").alias("day_of_year"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.month(day).cast("smallint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter_number"),
        F.year(day).cast("smallint").alias("calendar_year"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def describe_report_days(days: DataFrame) -> DataFrame:
    """The day attributes of the report calendar (adds month labels and the ISO year)."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("calendar_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        (F.year(day) * 100 + F.month(day)).alias("year_month_sort"),
        F.quarter(day).alias("quarter_number"),
        F.extract(F.lit("YEAROFWEEK"), day).alias("iso_year"),
        F.weekofyear(day).alias("iso_week"),
    )
