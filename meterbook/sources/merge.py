"""Keyed replacement inside a partitioned stored table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.sources.store import Store

BUCKET = "_bucket"
# Buckets of a table that is kept by key hash. Fixed once the table is there; a larger warehouse needs more.
BUCKETS = 16


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """The partition of a key: a delivery knows the partitions of its keys without looking them up."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_partitions(target: DataFrame | None, incoming: DataFrame, key: str, partition: str) -> list:
    """The partitions that hold a row of an incoming key now or will hold one.

    Finding them reads the key column only, of all partitions, unless the partition follows from the
    key. ``target`` is None where it holds none of the keys. ``partition`` is a calendar column or a bucket,
    so the list is short.
    """
    touched = incoming.select(partition)
    if partition != BUCKET and target is not None:
        touched = touched.union(target.join(incoming.select(key), key, "left_semi").select(partition))
    return [r[partition] for r in touched.distinct().collect()]


def merge_by_key(
    store: Store, layer: str, table: str, incoming: DataFrame, key: str, partition: str, touched: list | None = None
) -> list:
    """Replace the rows of the incoming keys and add the new ones, rewriting only what they touch.

    The store writes the new content to a separate place first: no plan overwrites the files it reads.
    ``incoming`` is read several times and should be a stored copy. Returns the partitions rewritten.
    """
    target = store.read(layer, table)
    if touched is None:
        touched = touched_partitions(target, incoming, key, partition)
    if touched:
        kept = target.filter(within(partition, touched)).join(incoming.select(key), key, "left_anti")
        content = kept.unionByName(incoming.select(*kept.columns))
        store.replace_partitions(content, layer, table, partition, touched)
    return touched


Parts = Callable[[Sequence], DataFrame]


def merge_partitions(
    store: Store, layer: str, table: str, incoming: Parts, gone: Parts, key: str, partition: str, touched: list
) -> None:
    """``merge_by_key`` where it is known which row lies in which partition: ``incoming`` and ``gone`` read the new
    rows and the keys of the rows that go of some partitions.

    A few partitions are rewritten at a time. Their rows stay where they are read as long as the list of keys
    that go is short enough for Spark to send around.
    """
    target = store.read(layer, table)

    def content(values: Sequence) -> DataFrame:
        kept = target.filter(within(partition, values)).join(gone(values).select(key), key, "left_anti")
        return kept.unionByName(incoming(values).select(*kept.columns))

    store.rewrite_partitions(layer, table, partition, touched, content)


def within(partition: str, values: Sequence) -> Column:
    """Membership that also finds the partition of missing values."""
    found = F.coalesce(F.col(partition).isin([v for v in values if v is not None]), F.lit(False))
    return found | F.col(partition).isNull() if None in values else found
