"""Run audit and rejected rows, both append-only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbook.functions import time_literal
from meterbook.sources.store import Store

LAYER = "monitoring"
RUNS, REJECTS = "ingestion_runs", "rejected_records"
PIPELINE = "meterbook.ingest"
RUNNING, SUCCESS, PARTIAL, FAILED = "RUNNING", "SUCCESS", "PARTIAL_SUCCESS", "FAILED"
TERMINAL = (SUCCESS, PARTIAL, FAILED)

RUN_SCHEMA = (
    "run_id string, pipeline_name string, source_name string, source_file string, started_at string, "
    "finished_at string, status string, rows_received bigint, rows_inserted bigint, rows_updated bigint, "
    "rows_rejected bigint, error_message string"
)


@dataclass
class Run:
    run_id: str
    source_name: str
    source_file: str
    started_at: datetime
    rows_received: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_rejected: int = 0
    status: str = RUNNING


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}_{uuid.uuid4().hex[:16]}"


def start_run(store: Store, source_name: str, source_file: str, now: datetime) -> Run:
    """SNK-03: the RUNNING row is written before anything is read, so a crash leaves a trace."""
    run = Run(new_run_id(), source_name, source_file, now)
    _record(store, run, None, None)
    return run


def finish_run(store: Store, run: Run, status: str, now: datetime, error_message: str | None = None) -> Run:
    if status not in TERMINAL:
        raise ValueError(f"not a final status: {status}")
    run.status = status
    _record(store, run, now, error_message)
    return run


def _record(store: Store, run: Run, finished_at: datetime | None, error_message: str | None) -> None:
    row = (
        run.run_id, PIPELINE, run.source_name, run.source_file, run.started_at.isoformat(),
        finished_at.isoformat() if finished_at else None, run.status, run.rows_received, run.rows_inserted,
        run.rows_updated, run.rows_rejected, error_message,
    )
    frame = store.spark.createDataFrame([row], RUN_SCHEMA).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("started_at", "finished_at")}
    )
    store.append(frame.coalesce(1), LAYER, RUNS)


def runs(store: Store) -> DataFrame:
    """One row per run: the finishing record where there is one, else the RUNNING one."""
    newest = Window.partitionBy("run_id").orderBy(F.col("finished_at").desc_nulls_last())
    records = store.read(LAYER, RUNS)
    return records.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def record_rejects(store: Store, rejects: DataFrame, run: Run, key: str, columns: tuple[str, ...], now: datetime):
    """SNK-02: identifier, reason and the whole row as JSON."""
    row = F.struct(*columns, F.col("_source_file"), F.lit(run.run_id).alias("_run_id"))
    payload = F.when(
        F.col("_raw_line").isNotNull(), F.to_json(F.struct(F.col("_raw_line").alias("raw_line")))
    ).otherwise(F.to_json(row, {"ignoreNullFields": "false"}))
    frame = rejects.select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.source_name).alias("source_name"),
        F.col(key).alias("source_record_identifier"),
        F.col("_reason").alias("reason"),
        payload.alias("raw_payload"),
        time_literal(now).alias("rejected_at"),
    )
    store.append(frame, LAYER, REJECTS)
