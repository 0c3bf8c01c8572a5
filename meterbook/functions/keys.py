"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for NULL inside a hashed key, and the separator.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: Column) -> Column:
    """FN-15: equal business keys give equal hashes on every run and every engine."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_MARKER)) for part in parts]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


# Longer than any packed hash, so that other texts cannot be mistaken for one.
_UNPACKED = "X'" + "00" * 17 + "'"


def packed_key(key: Column) -> Column:
    """A key in fewer bytes, for grouping and joining: half of those of a hash, equal exactly where keys are."""
    is_hash = (F.length(key) == 32) & (F.lower(F.hex(F.unhex(key))) == key)
    return F.when(is_hash, F.unhex(key)).otherwise(F.concat(F.expr(_UNPACKED), key.cast("binary")))


def unpacked_key(packed: Column) -> Column:
    """The key of a ``packed_key``."""
    text = F.substring(packed, 18, 2**31 - 1).cast("string")
    return F.when(F.length(packed) == 16, F.lower(F.hex(packed))).otherwise(text)
