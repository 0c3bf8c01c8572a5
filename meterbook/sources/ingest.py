"""Landing a source file: scan, validate, settle duplicates, upsert, and account for every row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.functions import safe_timestamp, time_literal
from meterbook.operators import validate
from meterbook.operators.dedup import mark_newest, maybe_repeated, newest_of_repeated
from meterbook.operators.upsert import upsert_counts
from meterbook.session import durable_copy
from meterbook.sources import audit
from meterbook.sources.merge import BUCKET, bucket_of, merge_by_key, touched_partitions
from meterbook.sources.readers import PLACE, read_source
from meterbook.sources.registry import INGESTION_ORDER, SOURCES, SourceSpec
from meterbook.sources.store import Store
from meterbook.sources.touched import log_days

RAW = "raw"
DAY = "_day"


def validated(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """VAL-01..05: rows with ``_reason``; a line that is no record keeps its parse error."""
    rules = {spec.key: validate.required(spec.key)}
    rules[spec.checked_time] = validate.valid_time(spec.checked_time, spec.time_required)
    for column, rule in rules.items():
        if f"_not_text_{column}" in rows.columns:
            rules[column] = validate.is_text(f"_not_text_{column}", rule)
    checked = validate.add_reasons(rows, list(rules.values()))
    return checked.withColumn("_reason", F.coalesce("_parse_error", "_reason"))


def repeated_keys(checked: DataFrame, spec: SourceSpec) -> DataFrame:
    """VAL-06, first step: the keys that a delivery has twice or more, each with the row that wins."""
    good = checked.filter(F.col("_reason").isNull()).select(spec.key, *_ranked_by(spec))
    # Places are long texts: only those of keys that may be repeated are compared.
    return newest_of_repeated(maybe_repeated(good, spec.key), spec.key, spec.version, PLACE)


def _ranked_by(spec: SourceSpec) -> list[str]:
    return [*([spec.version] if spec.version else []), *PLACE]


def settled(checked: DataFrame, repeated: DataFrame, spec: SourceSpec) -> DataFrame:
    """VAL-06: rows with ``_kept``. Losing duplicates get a reason and become rejects.

    Duplicates are settled over the whole delivery. Settling them in batches, with a later batch
    overwriting an earlier one, could let an older version win; here the newest always wins.
    ``checked`` is a stored copy: the place of a row is what was written, not counted again.
    """
    if repeated.isEmpty():
        return checked.withColumn("_kept", F.col("_reason").isNull())
    # A rejected row does not compete for its key.
    competes = checked.withColumn("_key", F.when(F.col("_reason").isNull(), F.col(spec.key)))
    marked = mark_newest(competes, "_key", spec.version, PLACE, "_wins", repeated.withColumnRenamed(spec.key, "_key"))
    kept = F.col("_reason").isNull() & F.col("_wins")
    reason = F.when(F.col("_reason").isNull() & ~F.col("_wins"), validate.DUPLICATE).otherwise(F.col("_reason"))
    return marked.withColumns({"_kept": kept, "_reason": reason}).drop("_wins", "_key")


def status_of(run: audit.Run) -> str:
    """VAL-08."""
    if run.rows_received == 0 or run.rows_rejected == 0:
        return audit.SUCCESS
    return audit.PARTIAL if run.rows_inserted + run.rows_updated > 0 else audit.FAILED


def ingest_source(store: Store, spec: SourceSpec, folder: str, now: datetime) -> audit.Run:
    """One source. Bad rows are rejected and the run goes on; a missing file ends it (SRC-05)."""
    path = f"{folder.rstrip('/')}/{spec.file_name}"
    run = audit.start_run(store, spec.name, spec.file_name, now)
    try:
        if not store.path_exists(path):
            raise FileNotFoundError(f"source file not found: {path}")
        _load(store, spec, path, run, now)
    except Exception as error:
        audit.finish_run(store, run, audit.FAILED, now, str(error))
        raise
    return audit.finish_run(store, run, status_of(run), now)


def _load(store: Store, spec: SourceSpec, path: str, run: audit.Run, now: datetime) -> None:
    rows = read_source(store.spark, spec, path)
    # The delivery is scanned and parsed once; everything after reads the copy.
    with durable_copy(validated(rows, spec)) as checked, durable_copy(repeated_keys(checked, spec)) as repeated:
        outcome = settled(checked, repeated, spec)
        landed = outcome.filter("_kept").select(
            *spec.columns,
            time_literal(now).alias("_ingested_at"),
            "_source_file",
            F.lit(run.run_id).alias("_run_id"),
        )
        counts = outcome.agg(F.count("*").alias("received"), F.count_if(~F.col("_kept")).alias("rejected")).first()
        inserted, updated = counts["received"] - counts["rejected"], 0
        if store.exists(RAW, spec.name):
            inserted, updated = upsert_counts(store.read(RAW, spec.name), landed, spec.key).first()
        _write(store, spec, landed, run, now, replaces=bool(updated))
        audit.record_rejects(store, outcome.filter(~F.col("_kept")), run, spec.key, spec.columns, now)
    # VAL-07: counted only now that both writes are in; received = inserted + updated + rejected.
    run.rows_received, run.rows_rejected = counts["received"], counts["rejected"]
    run.rows_inserted, run.rows_updated = inserted, updated


def _write(store: Store, spec: SourceSpec, landed: DataFrame, run: audit.Run, now: datetime, replaces: bool) -> None:
    """SNK-01. Entities are kept in buckets of their key, so a delivery rewrites the buckets of its keys.
    Sources without versions (events, invoices) grow without end, so they are partitioned by their day,
    only touched days are rewritten, and the days are logged for the refresh of facts. A delivery that
    replaces nothing is added without rewriting anything."""
    partition = BUCKET if spec.version else DAY
    if spec.version:
        landed = landed.withColumn(BUCKET, bucket_of(spec.key))
    else:
        landed = landed.withColumn(DAY, F.to_date(safe_timestamp(F.col(spec.checked_time))))
    there = store.exists(RAW, spec.name)
    touched = None
    if partition == DAY:
        held = store.read(RAW, spec.name) if there and replaces else None
        touched = touched_partitions(held, landed, spec.key, DAY)
        log_days(store, spec.name, run.run_id, now, touched)
    if not there:
        store.replace(landed, RAW, spec.name, [partition])
    elif replaces:
        merge_by_key(store, RAW, spec.name, landed, spec.key, partition, touched)
    else:
        store.append(landed, RAW, spec.name, [partition])


def ingest_all(
    store: Store, folder: str, now: datetime, sources: Sequence[str] = INGESTION_ORDER
) -> list[tuple[str, audit.Run | Exception]]:
    """Every source, parents first; one that fails does not stop the others."""
    results: list[tuple[str, audit.Run | Exception]] = []
    for name in sources:
        try:
            results.append((name, ingest_source(store, SOURCES[name], folder, now)))
        except Exception as error:  # noqa: BLE001 - recorded in the audit table and returned
            results.append((name, error))
    return results


def key_report(rows: DataFrame, source: str, key: str) -> DataFrame:
    """VAL-09: row count, duplicated keys and missing keys of one table, in one aggregation."""
    per_key = rows.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.lit(source).alias("source"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_row_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    )


def ingestion_report(store: Store, sources: Sequence[str] = INGESTION_ORDER) -> DataFrame:
    """VAL-09: what landed per source, beside the counts of all its runs."""
    tables = [key_report(store.read(RAW, s), s, SOURCES[s].key) for s in sources if store.exists(RAW, s)]
    landed = tables[0]
    for table in tables[1:]:
        landed = landed.unionByName(table)
    totals = audit.runs(store).groupBy(F.col("source_name").alias("source")).agg(
        F.count("*").alias("total_runs"),
        *[
            F.sum(c).alias(f"cumulative_{c}")
            for c in ("rows_received", "rows_inserted", "rows_updated", "rows_rejected")
        ],
    )
    return landed.join(totals, "source", "left")
