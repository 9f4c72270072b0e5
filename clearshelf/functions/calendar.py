"""Calendar columns. ISO weeks come from Spark; US weeks (Sunday start) are a closed formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _saturday(d: Column) -> Column:
    return F.date_add(d, 7 - F.dayofweek(d))


def us_week(d: Column) -> Column:
    """Week of year, weeks starting on Sunday and week 1 holding 1 January."""
    return (F.floor((F.dayofyear(_saturday(d)) - 1) / 7) + 1).cast("int")


def us_week_year(d: Column) -> Column:
    """Year the US week belongs to: the year of its Saturday."""
    return F.year(_saturday(d))


def with_us_calendar(df: DataFrame) -> DataFrame:
    """Add US week, week-year and month of ``date`` and of the day 365 days before."""
    last_year = F.date_sub("date", 365)
    return df.withColumns(
        {
            "week": us_week(F.col("date")),
            "year": us_week_year(F.col("date")),
            "month": F.month("date"),
            "week_ly": us_week(last_year),
            "year_ly": us_week_year(last_year),
            "month_ly": F.month(last_year),
        }
    )
