"""Calendar expressions and the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.scalar import date_key

OPEN_END = dt.date(9999, 12, 31)
FISCAL_START_MONTH = 7


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One ``full_date`` per day from ``start`` to ``end``, both included."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = spark.range((last - first).days + 1)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date"))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """Whole calendar years around the dates found in ``column``."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    days = F.sequence(
        F.trunc("lo", "year"), F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    )
    return span.select(F.explode(days).alias("full_date"))


def fiscal_year(day: Column) -> Column:
    return F.year(day) - (F.month(day) < FISCAL_START_MONTH).cast("int")


def fiscal_quarter(day: Column) -> Column:
    return (F.pmod(F.month(day) - FISCAL_START_MONTH, F.lit(12)) / 3).cast("int") + 1


def date_dimension(days: DataFrame) -> DataFrame:
    """The 15-column date dimension of ``full_date``; weekdays count from Monday = 0."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofyear(day).alias("day_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        fiscal_year(day).alias("fiscal_year"),
        fiscal_quarter(day).alias("fiscal_quarter"),
    )
