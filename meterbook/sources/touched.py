"""INC-01, INC-02: the log of days that deliveries touch.

A landing run appends the days it is about to write, before it writes them: the days of its rows, and
the days that held rows it replaces. A run that dies in between has logged too much, never too little,
and logs again when it is repeated. A refresh reads the log instead of the landed rows, so what it
costs follows what arrived, and it also finds days that lost a row to another day.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbook.functions import time_literal
from meterbook.sources.store import Store

LAYER, TABLE = "monitoring", "touched_days"
SCHEMA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("day", T.DateType()),
    ]
)


def log_days(store: Store, source: str, run_id: str, ingested_at: datetime, days: list) -> None:
    """The list of days is bounded by the calendar."""
    rows = [(source, run_id, ingested_at, d) for d in days]
    store.append(store.spark.createDataFrame(rows, SCHEMA).coalesce(1), LAYER, TABLE)


def has_log(store: Store, source: str) -> bool:
    return store.exists(LAYER, TABLE) and not store.read(LAYER, TABLE).filter(F.col("source_name") == source).isEmpty()


def days_touched(store: Store, source: str, after: datetime) -> DataFrame:
    """Days logged after a moment. Rows without a readable time have no day and are in no daily fact."""
    log = store.read(LAYER, TABLE)
    since = log.filter((F.col("source_name") == source) & (F.col("ingested_at") > time_literal(after)))
    return since.select("day").filter(F.col("day").isNotNull()).distinct()
