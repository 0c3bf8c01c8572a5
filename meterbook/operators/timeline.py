"""Milestones of a row as an ordered timeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.functions import elapsed_days


def milestone_timeline(df: DataFrame, keep: Sequence[str], milestones: Mapping[str, str]) -> DataFrame:
    """SET-01, WN-04, WN-05: unpivot, number and chain the milestones of each row.

    ``milestones`` maps a milestone name to its timestamp column; ties keep the order of the
    mapping. A row holds all of its own milestones, so a short sorted array does the work of a
    union, a numbering window and a lag window, and nothing is shuffled.
    """
    entries = [
        F.struct(F.col(column).alias("at"), F.lit(place).alias("place"), F.lit(name).alias("type"))
        for place, (name, column) in enumerate(milestones.items())
    ]
    present = F.filter(F.array(*entries), lambda entry: entry["at"].isNotNull())
    ordered = df.select(*keep, F.array_sort(present).alias("_steps"))
    numbered = F.transform(
        "_steps",
        lambda step, i: F.struct(
            (i + 1).cast("int").alias("transition_sequence"),
            step["type"].alias("transition_type"),
            step["at"].alias("transition_at"),
            F.get(F.col("_steps"), i - 1)["type"].alias("previous_transition_type"),
            F.get(F.col("_steps"), i - 1)["at"].alias("previous_transition_at"),
        ),
    )
    return (
        ordered.select(*keep, F.inline(numbered))
        .withColumn(
            "days_since_previous_transition",
            elapsed_days(F.col("previous_transition_at"), F.col("transition_at")),
        )
    )
