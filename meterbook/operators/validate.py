"""Row rules of the ingest. A rule is a Column: its reason where the row fails, NULL where it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.functions import safe_timestamp

# The wording of reasons, and the text between them.
SEPARATOR = "; "
NOT_TEXT = "Input should be a valid string"
DUPLICATE = "duplicate business key within source file"


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _is_blank(c: Column) -> Column:
    return c.isNull() | (_stripped(c) == "")


def required(name: str) -> Column:
    """VAL-01: an identifier that is more than white space."""
    return F.when(_is_blank(F.col(name)), f"Value error, missing required technical identifier: {name}")


def valid_time(name: str, needed: bool) -> Column:
    """VAL-02 (needed) and VAL-03 (may be missing, but must parse if present)."""
    c = F.col(name)
    unreadable = F.concat(F.lit("Value error, Unknown string format: "), _stripped(c))
    absent = F.lit(f"Value error, missing required timestamp: {name}" if needed else None).cast("string")
    return F.when(_is_blank(c), absent).when(safe_timestamp(_stripped(c)).isNull(), unreadable)


def is_text(flag: str, otherwise: Column) -> Column:
    """A value that arrived as a number or an object instead of text fails before its other rules."""
    return F.when(F.col(flag), NOT_TEXT).otherwise(otherwise)


def add_reasons(df: DataFrame, rules: Sequence[Column], reason: str = "_reason") -> DataFrame:
    """VAL-04: all failed rules of a row in one text, NULL for a good row."""
    return df.withColumn(reason, F.nullif(F.concat_ws(SEPARATOR, *rules), F.lit("")))
