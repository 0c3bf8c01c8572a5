"""Versioned history of slowly changing rows (SCD type 2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterbook.functions import time_literal

FROM, TO = "valid_from", "valid_to"


def first_history(source: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """The history after the first run: every row is current."""
    return source.withColumn(FROM, F.col(updated_at)).withColumn(TO, F.lit(None).cast("timestamp"))


def merge_current(
    current: DataFrame, source: DataFrame, key: str, run_at: datetime, updated_at: str = "updated_at"
) -> DataFrame:
    """SCD-01..03: one run over the current versions. Returns open and newly closed versions.

    A newer ``updated_at`` closes the current version at that time and opens a new one. An equal,
    older or missing ``updated_at`` changes nothing. A key that left the source is closed at
    ``run_at``. One full outer join on the key does all of it: both sides are unique per key.
    """
    columns = [c for c in source.columns if c != key]
    old = current.select(key, F.struct(*columns, FROM, TO).alias("_old"))
    new = source.select(key, F.struct(*columns).alias("_new"))
    both = old.join(new, key, "full_outer")

    newer = F.col(f"_new.{updated_at}") > F.col("_old.valid_from")
    gone = F.col("_new").isNull()
    old_end = F.when(gone, time_literal(run_at)).when(newer, F.col(f"_new.{updated_at}"))
    versions = F.array(
        F.when(F.col("_old").isNotNull(), _version("_old", columns, F.col("_old.valid_from"), old_end)),
        F.when(
            F.col("_new").isNotNull() & (F.col("_old").isNull() | newer),
            _version("_new", columns, F.col(f"_new.{updated_at}"), F.lit(None).cast("timestamp")),
        ),
    )
    rows = both.select(key, F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v"))
    return rows.select(key, *[F.col(f"v.{c}").alias(c) for c in (*columns, FROM, TO)]).select(
        *source.columns, FROM, TO
    )


def _version(side: str, columns: list[str], begin: Column, end: Column) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], begin.alias(FROM), end.alias(TO))


def merge_history(
    history: DataFrame, source: DataFrame, key: str, run_at: datetime, updated_at: str = "updated_at"
) -> DataFrame:
    """SCD-01..03 over a whole history: closed versions pass through unchanged."""
    closed = history.filter(F.col(TO).isNotNull())
    return closed.unionByName(merge_current(current_versions(history), source, key, run_at, updated_at))


def current_versions(history: DataFrame) -> DataFrame:
    """SCD-04."""
    return history.filter(F.col(TO).isNull())


def malformed_intervals(history: DataFrame) -> DataFrame:
    """SCD-05: versions without a start, or that do not end after they start."""
    return history.filter(F.col(FROM).isNull() | (F.col(TO) <= F.col(FROM)))


def previous_values(history: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """WN-08: each version with the values of the one before. A group is the versions of one key,
    which grows with its changes, not with the table."""
    order = Window.partitionBy(key).orderBy(F.col(FROM).asc_nulls_last())
    return history.select("*", *[F.lag(c).over(order).alias(f"previous_{c}") for c in columns])
