"""Many-to-one lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.operators import dedup


def lookup(
    rows: DataFrame,
    reference: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | None = None,
    matched: str | None = None,
) -> DataFrame:
    """JN-01..11: left join to a side that is unique on its key; the row count stays.

    ``on`` maps columns of ``rows`` to columns of ``reference``, ``take`` maps new names to columns
    of ``reference``, and ``matched`` names a flag telling whether a partner was found. No side is
    forced to broadcast: reference tables grow with the business, so Spark decides by measured
    size, and its skew handling splits a hot key on the many side.
    """
    take = take or {}
    keyed = reference.select(
        *[F.col(r).alias(f"_on_{i}") for i, r in enumerate(on.values())],
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    condition: Column = F.lit(True)
    for i, left in enumerate(on):
        condition = condition & (rows[left] == keyed[f"_on_{i}"])
    joined = rows.join(keyed, condition, "left")
    if matched:
        joined = joined.withColumn(matched, F.col("_on_0").isNotNull())
    return joined.drop(*[f"_on_{i}" for i in range(len(on))])


def known(rows: DataFrame, checks: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """JN-08..11 where most keys have a partner: flags telling whether it exists, for rows that stay where they are.

    ``checks`` maps a flag to a key of ``rows``, a reference that is unique on its key, and that key. A lookup
    moves whole rows to find a flag. Here only distinct keys meet the references; hashes of the keys without a
    partner are sent around, and rows with such a hash are looked up. A key whose hash is not among them has a
    partner. The lists are bounded like those of repeated keys: if one would be longer, all rows are looked up.
    ``rows`` is scanned several times, so it should be stored or cheap to derive.
    """
    marked, doubtful = rows, F.lit(False)
    for i, (key, reference, reference_key) in enumerate(checks.values()):
        keys = rows.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()
        lost = keys.join(reference.select(F.col(reference_key).alias("_key")), "_key", "left_anti")
        listed = lost.select(F.xxhash64("_key").alias(f"_lost_{i}")).distinct().limit(dedup.LISTED_HASHES + 1)
        too_many = listed.agg(F.count("*") > dedup.LISTED_HASHES).scalar()
        marked = marked.join(F.broadcast(listed), F.xxhash64(marked[key]) == listed[f"_lost_{i}"], "left")
        doubtful = doubtful | F.col(f"_lost_{i}").isNotNull() | too_many
    found = marked.filter(doubtful).select(*rows.columns)
    for flag, (key, reference, reference_key) in checks.items():
        found = lookup(found, reference, {key: reference_key}, matched=flag)
    sure = {flag: F.col(key).isNotNull() for flag, (key, _, _) in checks.items()}
    return found.unionByName(marked.filter(~doubtful).select(*rows.columns).withColumns(sure))


def orphaned(key: str, matched: str) -> Column:
    """PRJ-03: the key is there, its partner is not."""
    return F.col(key).isNotNull() & ~F.col(matched)


def unmatched_counts(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, keep: Sequence[str] = ()
) -> DataFrame:
    """JN-27: per child key, its row count and whether the parent has it.

    The child is counted per key first, so a hot key joins as one row.
    """
    counted = child.groupBy(child_key, *keep).agg(F.count("*").alias("rows"))
    return lookup(counted, parent.select(parent_key).distinct(), {child_key: parent_key}, matched="has_parent")
