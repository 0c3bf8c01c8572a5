"""Dates and times. Every clock is an argument: nothing here reads the current time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_literal(moment: datetime) -> Column:
    """A UTC moment, independent of the driver's own time zone."""
    return F.lit(moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")


def date_literal(day: date | datetime) -> Column:
    return F.lit(day.strftime("%Y-%m-%d")).cast("date")


def elapsed_days(earlier: Column, later: Column) -> Column:
    """FN-18: whole days, truncated toward zero; a count of day boundaries would differ."""
    return F.extract(F.lit("DAY"), later - earlier)


def month_start(day: Column) -> Column:
    """FN-20."""
    return F.trunc(day, "MM")


def months_between_starts(earlier: Column, later: Column) -> Column:
    """FN-22: for first days of months."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def in_trailing_days(day: Column, as_of: date | datetime, days: int, skip: int = 0) -> Column:
    """FN-23: the ``days`` days ending ``skip`` days before ``as_of``, its own day included."""
    end = F.date_sub(date_literal(as_of), skip)
    return (day > F.date_sub(date_literal(as_of), skip + days)) & (day <= end)


def age_in_hours(earlier: Column, later: Column) -> Column:
    """FN-30."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)


def calendar_columns(day: Column) -> list[Column]:
    """FN-21: the parts of a day that reports group by."""
    weekday = F.weekday(day) + 1
    return [
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        month_start(day).alias("month_start_date"),
        F.date_format(day, "yyyy-MM").alias("month_label"),
        F.weekofyear(day).alias("week_number"),
        weekday.alias("day_of_week_number"),
        weekday.isin(6, 7).alias("is_weekend"),
    ]
