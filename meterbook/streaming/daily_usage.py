"""STR-01: the daily usage fact kept current from a stream of landed events.

Each micro-batch is stored by event day and the days it touches are rebuilt from all stored rows
of those days, so an event may be any amount of time late. Duplicates are settled over the stored
rows, where a bounded streaming state would have to forget them. An index from event to day, in key-hash
buckets, tells which stored days hold an event that comes again; stored rows and index are gathered every
few batches. Whole rows are moved and ranked only of events that are stored more than once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterbook.functions import safe_timestamp
from meterbook.operators.dedup import latest_per_key, settle_repeated
from meterbook.plans import staging
from meterbook.plans.facts import keyed_product_usage, matched_product_usage
from meterbook.session import durable_copy
from meterbook.sources.merge import BUCKET, bucket_of, within
from meterbook.sources.registry import SOURCES
from meterbook.streaming.batches import GATHER_AFTER, BatchTable

KEY = "event_id"
DAY, MARKER = "event_day", "is_marker"
COLUMNS = SOURCES["product_events"].columns
LANDED = (
    SOURCES["product_events"]
    .schema.add("_ingested_at", T.TimestampType())
    .add("_source_file", T.StringType())
    .add("_run_id", T.StringType())
)
STORED = T.StructType(list(LANDED)).add(MARKER, T.BooleanType()).add(DAY, T.DateType())
INDEXED = T.StructType().add(KEY, T.StringType()).add(DAY, T.DateType()).add(BUCKET, T.IntegerType())


def newest(rows: DataFrame, *within: str) -> DataFrame:
    return latest_per_key(rows, [KEY, *within], ["_ingested_at"], tie_break=[c for c in COLUMNS if c != KEY])


def newest_by_day(rows: DataFrame) -> DataFrame:
    """What a day needs to know of its events. An event's own rows outlast copies of the same version."""
    rank = [c for c in COLUMNS if c != KEY]
    marker = F.when(F.col(MARKER), 0).otherwise(1)
    own = rows.withColumn("_own", marker)
    return latest_per_key(own, [KEY, DAY], ["_ingested_at"], tie_break=[*rank, "_own"]).drop("_own")


def _on_several_days(arrived: DataFrame, stored: DataFrame) -> DataFrame:
    """The events of a batch that more than one day holds; no day counts as one."""
    again = stored.join(arrived.select(KEY), KEY, "left_semi")
    held = arrived.select(KEY, DAY).unionByName(again.select(KEY, DAY)).filter(F.col(KEY).isNotNull())
    days = held.groupBy(KEY).agg(
        F.min(DAY).alias("_first"), F.max(DAY).alias("_last"), F.count(DAY).alias("_dated"), F.count("*").alias("_all")
    )
    return days.filter("_first <> _last or _dated between 1 and _all - 1").select(KEY)


@dataclass(frozen=True)
class UsageStream:
    """Where the stream keeps its rows and its fact, and the dimensions of the fact."""

    spark: SparkSession
    folder: str
    users: DataFrame
    organizations: DataFrame

    gather_after: int = GATHER_AFTER

    @property
    def events(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.folder}/events", STORED, DAY)

    @property
    def index(self) -> BatchTable:
        """The days that hold a row of an event."""
        return BatchTable(self.spark, f"{self.folder}/event_days", INDEXED, BUCKET)

    @property
    def fact_path(self) -> str:
        return f"{self.folder}/fact_product_usage"

    def fact(self) -> DataFrame:
        return self.spark.read.parquet(self.fact_path)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch. Running the same batch again gives the same folders and the same days."""
        self.events.gather(batch_id, self.gather_after, newest_by_day)
        self.index.gather(batch_id, self.gather_after, DataFrame.distinct)
        day = F.to_date(safe_timestamp(F.col("event_timestamp")))
        self.events.write(batch.select(*LANDED.names, F.lit(False).alias(MARKER), day.alias(DAY)), batch_id)
        arrived = self.events.of_batch(batch_id)
        # Copies of an event stay in the index until it is gathered: dropping them here would move all keys twice.
        self.index.write(arrived.select(KEY, DAY, bucket_of(KEY).alias(BUCKET)), batch_id)
        self._mark(batch_id)
        # The days of one batch are bounded by the calendar.
        days = [r[DAY] for r in self.events.of_batch(batch_id).select(DAY).distinct().collect() if r[DAY]]
        if days:
            self._rebuild(days)

    def _mark(self, batch_id: int) -> None:
        """Adds copies of the newest version of an event for the other days that hold a version of it.

        An event that comes again under another day must no longer count on its old day, and a
        version that comes late must not count beside a newer one. With these copies every day can
        tell the newest version of its events by itself, so a rebuild reads only its own days.
        """
        arrived = self.index.of_batch(batch_id)
        buckets = [r[BUCKET] for r in arrived.select(BUCKET).distinct().collect()]
        stored = self.index.read(before=batch_id).filter(F.col(BUCKET).isin(buckets))
        # An event that one day holds has no other day to be marked on, and most events are such.
        with durable_copy(_on_several_days(arrived, stored)) as moved:
            if not moved.isEmpty():
                self.events.write(self._markers(moved, buckets), batch_id, "append")

    def _markers(self, moved: DataFrame, buckets: list) -> DataFrame:
        index = self.index.read().filter(F.col(BUCKET).isin(buckets))
        held = index.join(moved, KEY, "left_semi").select(KEY, F.col(DAY).alias("_held")).distinct()
        # Whole rows are read only of days that hold one of the events.
        days = [r["_held"] for r in held.select("_held").distinct().collect()]
        versions = self.events.read().filter(within(DAY, days)).join(moved, KEY, "left_semi")
        own = newest(versions.filter(~F.col(MARKER)))
        elsewhere = own.join(held.filter("_held is not null"), KEY).filter(~F.col("_held").eqNullSafe(F.col(DAY)))
        return elsewhere.select(*LANDED.names, F.lit(True).alias(MARKER), F.col("_held").alias(DAY))

    def _rebuild(self, days: list) -> None:
        stored = self.events.read().filter(F.col(DAY).isin(days))
        rows = settle_repeated(stored, KEY, newest, lambda once: once)
        staged = staging.product_events(rows, unique=True).filter(F.to_date("event_timestamp").isin(days))
        matched = matched_product_usage(staged, self.users, self.organizations)
        before = {day: self._files_of(day) for day in days}
        (
            keyed_product_usage(matched.hint("rebalance", F.col("date_day")))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date_day")
            .parquet(self.fact_path)
        )
        # Replacing partitions leaves a day alone that has no rows any more; its folder goes. Every write
        # names its files anew, so such a day is one that still has files of before.
        for day in days:
            if before[day] & self._files_of(day):
                self._drop_day(day)

    def _files_of(self, day) -> set[str]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.fact_path}/date_day={day}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return {s.getPath().getName() for s in files.listStatus(where)} if files.exists(where) else set()

    def _drop_day(self, day) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.fact_path}/date_day={day}")
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def start(
    stream: UsageStream,
    events: DataFrame,
    checkpoint: str,
    after_batch: Callable[[DataFrame, int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """``events`` is a streaming frame of landed events with their lineage columns."""

    def process(batch: DataFrame, batch_id: int) -> None:
        stream.process(batch, batch_id)
        if after_batch:
            after_batch(batch, batch_id)

    return (
        events.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
