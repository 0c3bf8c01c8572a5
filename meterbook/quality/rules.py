"""DQ-01..09: declared rules. Each can list its violating rows or just count them.

Counting is what runs over every table, so the rules of one table that look at single rows share
one scan of it, and key rules aggregate before they shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.functions import packed_key
from meterbook.functions.cleaning import KNOWN_CURRENCIES
from meterbook.operators.lookup import unmatched_counts

ERROR, WARN = "ERROR", "WARN"

RESULT = "model string, rule string, columns string, severity string, violations bigint"


@dataclass(frozen=True)
class Rule:
    model: str
    kind: str
    columns: tuple[str, ...]
    severity: str = ERROR
    values: tuple[str, ...] = ()  # accepted_values
    parent: tuple[str, str] | None = None  # relationships: model and column
    where: str | None = None  # unique: which rows count
    labels: str = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "labels", ",".join(self.columns))


def row_condition(rule: Rule) -> Column | None:
    """True for a violating row, if the rule looks at single rows."""
    c = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return ~c.isin(*rule.values)
    if rule.kind == "positive_or_zero":
        return c < 0
    if rule.kind == "fraction":
        return (c < 0) | (c > 1)
    if rule.kind == "valid_currency_code":
        return ~c.isin(*KNOWN_CURRENCIES)
    if rule.kind == "valid_timestamp_order":
        return F.col(rule.columns[1]) < c
    return None


def _compact(column: str) -> Column:
    """A column to count by: hashed keys in half their bytes."""
    return packed_key(F.col(column)).alias(column) if column.endswith("_key") else F.col(column)


def _repeated(df: DataFrame, rule: Rule) -> DataFrame:
    """AG-15: keys that occur more than once, NULLs as one value."""
    if rule.where:
        df = df.filter(rule.where)
    return df.groupBy(*rule.columns).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def _counts_key(rule: Rule) -> Column:
    return F.col(rule.columns[0]).isNotNull() if rule.kind == "unique" else F.lit(True)


def _duplicated(df: DataFrame, rule: Rule) -> DataFrame:
    """AG-15: keys that occur more than once; in a combination NULLs count as one value."""
    return _repeated(df, rule).filter(_counts_key(rule))


def violations(df: DataFrame, rule: Rule, table: Callable[[str], DataFrame]) -> DataFrame:
    """The violating rows, or the violating keys with their row counts."""
    condition = row_condition(rule)
    if condition is not None:
        return df.filter(condition)
    if rule.kind in ("unique", "unique_combination"):
        return _duplicated(df, rule)
    if rule.kind == "relationships":
        child, (parent, key) = rule.columns[0], rule.parent
        present = df.filter(F.col(child).isNotNull())
        return present.join(table(parent).select(F.col(key).alias(child)), child, "left_anti")
    raise ValueError(f"unknown rule: {rule.kind}")


def _result(rule: Rule, count: Column) -> Column:
    return F.struct(
        F.lit(rule.model).alias("model"),
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.labels).alias("columns"),
        F.lit(rule.severity).alias("severity"),
        count.cast("bigint").alias("violations"),
    )


def _key_counts(rule: Rule, table: Callable[[str], DataFrame]) -> DataFrame:
    parent, key = rule.parent
    child = table(rule.model).select(_compact(rule.columns[0])).filter(F.col(rule.columns[0]).isNotNull())
    counted = unmatched_counts(child, rule.columns[0], table(parent).select(_compact(key)), key)
    count = F.coalesce(F.sum(F.when(~F.col("has_parent"), F.col("rows"))), F.lit(0))
    return counted.agg(count.alias("n")).select(F.inline(F.array(_result(rule, F.col("n")))))


def _repeat_counts(rules: Sequence[Rule], table: Callable[[str], DataFrame]) -> DataFrame:
    """Rules on the same columns of a model, from one grouping: NULL is a value in a combination, none in a
    unique column."""
    rule = rules[0]
    df = table(rule.model)
    if any(c.endswith("_key") for c in rule.columns):
        df = df.withColumns({c: _compact(c) for c in rule.columns})
    repeated = _repeated(df, rule)
    counts = repeated.agg(*[F.count_if(_counts_key(rule)).alias(f"n{i}") for i, rule in enumerate(rules)])
    return counts.select(F.inline(F.array(*[_result(rule, F.col(f"n{i}")) for i, rule in enumerate(rules)])))


def count_violations(rules: Sequence[Rule], table: Callable[[str], DataFrame]) -> DataFrame:
    """One row per rule: ``RESULT``. All rules are one query of independent branches."""
    parts: list[DataFrame] = []
    for model in dict.fromkeys(rule.model for rule in rules):
        own = [rule for rule in rules if rule.model == model]
        by_row = [rule for rule in own if row_condition(rule) is not None]
        if by_row:
            counts = table(model).agg(
                *[F.count_if(row_condition(rule)).alias(f"n{i}") for i, rule in enumerate(by_row)]
            )
            results = F.array(*[_result(rule, F.col(f"n{i}")) for i, rule in enumerate(by_row)])
            parts.append(counts.select(F.inline(results)))
        by_key = [rule for rule in own if row_condition(rule) is None]
        parts.extend(_key_counts(rule, table) for rule in by_key if rule.kind == "relationships")
        same_key: dict[tuple, list[Rule]] = {}
        for rule in by_key:
            if rule.kind != "relationships":
                same_key.setdefault((rule.columns, rule.where), []).append(rule)
        parts.extend(_repeat_counts(found, table) for found in same_key.values())
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined
