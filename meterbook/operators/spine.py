"""Generated rows: days and month periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.functions import date_literal


def observed_bounds(
    frames: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]], at_least: datetime
) -> DataFrame:
    """FN-24, AG-16: the earliest and latest day seen in several tables, ``at_least`` included.

    Each entry is (table, columns for the minimum, columns for the maximum): one pass per table.
    """
    parts = [
        frame.agg(
            _extreme(F.min, F.least, lows).alias("low"),
            _extreme(F.max, F.greatest, highs).alias("high"),
        )
        for frame, lows, highs in frames
    ]
    bounds = parts[0]
    for part in parts[1:]:
        bounds = bounds.unionByName(part)
    return bounds.agg(
        F.min("low").alias("first_day"),
        F.greatest(F.max("high"), date_literal(at_least)).alias("last_day"),
    )


def _extreme(aggregate, combine, columns: Sequence[str]) -> Column:
    values = [F.to_date(aggregate(c)) for c in columns]
    if not values:
        return F.lit(None).cast("date")
    return values[0] if len(values) == 1 else combine(*values)


def day_spine(bounds: DataFrame, name: str = "date_day") -> DataFrame:
    """GEN-01: every day from first to last; none when the bounds are empty or reversed."""
    days = F.when(
        F.col("first_day") <= F.col("last_day"),
        F.sequence("first_day", "last_day", F.expr("interval 1 day")),
    )
    return bounds.select(F.explode(days).alias(name))


def period_grid(months: DataFrame, month: str, last_month: Column, periods: int = 24) -> DataFrame:
    """GEN-02, JN-14, FN-27: each month with the period numbers that can be observed by now."""
    return months.withColumn("period_index", F.explode(F.sequence(F.lit(0), F.lit(periods)))).filter(
        F.add_months(month, F.col("period_index")) <= last_month
    )
