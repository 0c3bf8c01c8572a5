"""Incremental recomputation that is safe for late rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.functions import time_literal

LOOKBACK_DAYS = 3
EPOCH = datetime(1970, 1, 1)


def watermark(target: DataFrame, ingested_at: str = "_last_ingested_at") -> Column:
    """INC-01: the newest ingest time the target has seen, as a one-value subquery."""
    return F.coalesce(target.agg(F.max(ingested_at)).scalar(), time_literal(EPOCH))


def read_watermark(target: DataFrame, ingested_at: str = "_last_ingested_at") -> datetime:
    """INC-01 as a plain value, so that it reaches the scan of a stored table as a filter."""
    newest = target.agg(F.date_format(F.max(ingested_at), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()["t"]
    return datetime.fromisoformat(newest) if newest else EPOCH


def cut(mark: datetime, lookback_days: int = LOOKBACK_DAYS) -> datetime:
    """The watermark less the lookback."""
    return max(mark - timedelta(days=lookback_days), EPOCH)


def ingested_after(ingested_at: str, mark: Column | datetime, lookback_days: int = LOOKBACK_DAYS) -> Column:
    """INC-01: rows that arrived after the watermark less the lookback."""
    if isinstance(mark, datetime):
        return F.col(ingested_at) > time_literal(cut(mark, lookback_days))
    return F.col(ingested_at) > mark - F.make_dt_interval(days=F.lit(lookback_days))


def affected_days(
    rows: DataFrame, event_time: str, ingested_at: str, mark: Column | datetime, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """INC-02: the event days that got a row since the watermark."""
    fresh = rows.filter(ingested_after(ingested_at, mark, lookback_days))
    return fresh.select(F.to_date(event_time).alias("_day")).filter(F.col("_day").isNotNull()).distinct()


def stale_days(
    target: DataFrame,
    rows: DataFrame,
    event_time: str,
    count_column: str,
    mark: datetime,
    target_day: str = "date_day",
    ingested_at: str = "_ingested_at",
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """INC-02 for stored facts: the affected days, and the days whose row count no longer agrees.

    A row that is delivered again with another event day leaves its old day one row short. Watching
    arrivals alone misses that day; comparing counts finds it. ``vanished`` marks days that lost
    all their rows. Both sides are one row per day when they meet.
    """
    source = (
        rows.groupBy(F.to_date(event_time).alias("_day"))
        .agg(F.count("*").alias("_rows"), F.max(ingested_at).alias("_newest"))
        .filter(F.col("_day").isNotNull())
    )
    held = target.groupBy(F.col(target_day).alias("_day")).agg(F.sum(count_column).alias("_held"))
    both = source.join(held, "_day", "full_outer")
    fresh = ingested_after("_newest", mark, lookback_days)
    return both.filter(fresh | ~F.col("_rows").eqNullSafe(F.col("_held"))).select(
        "_day", F.col("_rows").isNull().alias("vanished")
    )


def refresh_days(
    target: DataFrame,
    rows: DataFrame,
    rebuild: Callable[[DataFrame], DataFrame],
    event_time: str,
    target_day: str = "date_day",
    ingested_at: str = "_ingested_at",
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """INC-02: rebuild each affected day from all its rows; other days stay as they are.

    Whole days are replaced, so groups that vanished from a day go away too. The list of days is
    bounded by the calendar (about 36,500 values in a century), so it may be broadcast.
    """
    days = F.broadcast(affected_days(rows, event_time, ingested_at, watermark(target), lookback_days))
    touched = rows.join(days, F.to_date(rows[event_time]) == days["_day"], "left_semi")
    kept = target.join(days, target[target_day] == days["_day"], "left_anti")
    return kept.unionByName(rebuild(touched))


def refresh_keys(
    target: DataFrame, touched: DataFrame, rebuild: Callable[[DataFrame], DataFrame], key: str
) -> DataFrame:
    """INC-03: replace the target rows of the touched keys by their rebuilt rows."""
    kept = target.join(touched.select(key), key, "left_anti")
    return kept.unionByName(rebuild(touched))
