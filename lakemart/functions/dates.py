"""Calendar arithmetic that counts boundaries crossed instead of elapsed time.

Spark's own ``timestampdiff`` / ``months_between`` measure elapsed time, so 00:59 -> 01:01 is 0 hours.
Every lag in the models counts clock boundaries (that pair is 1 hour), hence these helpers.
All results are BIGINT, NULL when a side is NULL, and negative when ``end`` precedes ``start``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_crossed(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def hours_crossed(start: Column, end: Column) -> Column:
    return days_crossed(start, end) * 24 + F.hour(end) - F.hour(start)


def months_crossed(start: Column, end: Column) -> Column:
    years = F.year(end) - F.year(start)
    return (years * 12 + F.month(end) - F.month(start)).cast("bigint")


def month_start(day: Column) -> Column:
    """First day of the month as DATE (``date_trunc`` would give a zoned timestamp)."""
    return F.trunc(day, "MM")


def weekday_from_sunday(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(day) - 1).cast("bigint")


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of the date dimension, for any DATE column."""
    weekday = weekday_from_sunday(day)
    return [
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.quarter(day).cast("bigint").alias("quarter"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]
