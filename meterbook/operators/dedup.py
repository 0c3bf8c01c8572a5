"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WN-01..03: the first row of each key in ``order``.

    The rank filter lets Spark keep only the best row per key in each map task before the shuffle
    (``WindowGroupLimit`` in the plan), so a key that holds a third of all rows sends one row per
    map task, not its whole group, to the task that ranks it.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """WN-01: the newest version; equal versions are settled by content, never by arrival."""
    order = [F.col(c).desc_nulls_last() for c in (*newest_first, *tie_break)]
    return first_per_key(df, keys, order)


# Hashes of repeated keys that every task may hold: 16 MB. With more of them all rows are ranked.
LISTED_HASHES = 2_000_000


def settle_repeated(
    rows: DataFrame, key: str, settle: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """WN-01 where most keys occur once: ``settle`` gets the rows whose key may be repeated, ``rest`` the others.

    Ranking sorts whole rows twice, before the shuffle and after it. Here hashes are counted, and only rows
    whose hash occurs twice or more are ranked; a key without a partner cannot be among the others. ``rows``
    is scanned three times, so it should be stored or cheap to derive. The list that is sent around is
    bounded: if it would be longer than ``LISTED_HASHES``, ``settle`` gets everything.
    """
    marked, ranked = _maybe_repeated(rows, key)
    return settle(marked.filter(ranked).drop("_hash")).unionByName(rest(marked.filter(~ranked).drop("_hash")))


def maybe_repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows of all keys that occur twice or more, and few others: what ``settle_repeated`` would rank."""
    marked, ranked = _maybe_repeated(rows, key)
    return marked.filter(ranked).drop("_hash")


def _maybe_repeated(rows: DataFrame, key: str) -> tuple[DataFrame, Column]:
    hashed = rows.select(F.xxhash64(key).alias("_hash"))
    repeated = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("_hash")
    listed = repeated.limit(LISTED_HASHES + 1)
    too_many = listed.agg(F.count("*") > LISTED_HASHES).scalar()
    marked = rows.join(F.broadcast(listed), F.xxhash64(rows[key]) == listed["_hash"], "left")
    return marked, F.col("_hash").isNotNull() | too_many


def _rank(version: str | None, position: Sequence[str]) -> Column:
    newest = F.coalesce(F.col(version), F.lit("")) if version else F.lit("")
    return F.struct(newest.alias("_version"), *position)


def newest_of_repeated(df: DataFrame, key: str, version: str | None, position: Sequence[str]) -> DataFrame:
    """VAL-06: keys that occur twice or more, with the rank of the row that wins: the greatest
    ``version`` text, the later ``position`` on a tie (or just the later position without a version).

    The aggregate combines before the shuffle, so no task holds all the copies of a hot key.
    """
    found = df.groupBy(key).agg(F.count("*").alias("_n"), F.max(_rank(version, position)).alias("_best"))
    return found.filter("_n > 1").drop("_n")


def mark_newest(
    df: DataFrame, key: str, version: str | None, position: Sequence[str], flag: str, repeated: DataFrame | None = None
) -> DataFrame:
    """VAL-06: flag the row that wins its key; the others become rejects. Only keys that are repeated
    (``repeated``, from ``newest_of_repeated`` over the same rows) have a partner in the join. ``position``
    must be stored with the rows and unique, not counted anew with each scan."""
    repeated = newest_of_repeated(df, key, version, position) if repeated is None else repeated
    wins = F.col("_best").isNull() | _rank(version, position).eqNullSafe(F.col("_best"))
    return df.join(repeated, key, "left").withColumn(flag, wins).drop("_best")
