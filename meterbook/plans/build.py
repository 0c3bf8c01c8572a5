"""Building the stored warehouse: full tables, incremental facts and history."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.functions import month_start
from meterbook.operators import history, incremental
from meterbook.plans import facts, staging
from meterbook.plans.warehouse import Warehouse
from meterbook.session import durable_copy, durable_parts
from meterbook.sources.ingest import DAY
from meterbook.sources.key_index import KeyIndex
from meterbook.sources.merge import BUCKETS, bucket_of, merge_partitions
from meterbook.sources.registry import SOURCES
from meterbook.sources.store import Store, is_large
from meterbook.sources.touched import days_touched, has_log

RAW, STAGING, ANALYTICS, SNAPSHOTS = "raw", "staging", "analytics", "snapshots"

CONCURRENT_WRITES = 8
STORED_STAGING = ("stg_organizations", "stg_users", "stg_subscriptions", "stg_invoices", "stg_crm_accounts")
DIMENSIONS = ("dim_date", "dim_organizations", "dim_plans", "dim_users")
MARTS = (
    "mart_daily_growth", "mart_trial_conversion", "mart_acquisition_channels", "mart_retention_cohorts",
    "mart_feature_adoption", "mart_enterprise_growth", "mart_mrr", "mart_arr", "mart_arpu", "mart_customer_churn",
    "mart_revenue_churn", "mart_customer_ltv", "mart_api_usage",
)
MONTH = "issued_month"
# Partitions of a stored history.
PART, OPEN, CLOSED = "_part", "open-", "closed-"


def refresh_daily_fact(
    store: Store,
    table: str,
    staged: DataFrame,
    event_time: str,
    count_column: str,
    rebuild: Callable[[DataFrame], DataFrame],
    full_refresh: bool = False,
    staged_days: Callable[[list], DataFrame] | None = None,
    source: str | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """INC-01, INC-02, INC-05, INC-06 on a stored fact that is partitioned by day.

    ``staged_days`` gives the staged rows of some days where they can be read without the others. If
    ``source`` landed with a log of the days it touched, the log tells which days to rebuild and only
    their landed rows are read. Otherwise counts of all days are compared. ``finish`` completes rebuilt
    rows once they are with the others of their day.
    """
    if full_refresh or not store.exists(ANALYTICS, table):
        return store.replace(rebuild(staged), ANALYTICS, table, ["date_day"], finish)
    target = store.read(ANALYTICS, table)
    mark = incremental.read_watermark(target)
    if source and staged_days and has_log(store, source):
        stale = days_touched(store, source, incremental.cut(mark))
    else:
        stale = incremental.stale_days(target, staged, event_time, count_column, mark)
    # The list of days is bounded by the calendar; as literals they prune what is read and rewritten.
    days = [r[0] for r in stale.collect()]
    if not days:
        return target
    rows = staged if staged_days is None else staged_days(days)
    rebuilt = finish(rebuild(rows.filter(F.to_date(event_time).isin(days))))
    store.replace_partitions(rebuilt, ANALYTICS, table, "date_day", days)
    return store.read(ANALYTICS, table)


def refresh_invoices(
    store: Store,
    landed: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    rebuild: Callable[[DataFrame], DataFrame],
    full_refresh: bool = False,
    staged: DataFrame | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """INC-03 on a stored fact that is partitioned by the month of issue.

    ``staged`` has all landed rows staged, if they are stored already; a whole build reads them. Otherwise they
    are stored for the time being, since ``rebuild`` may read its rows several times.
    ``finish`` completes rebuilt rows once they are with the others of their month.

    Only rows that landed after the watermark are staged: the newest version of an invoice wins, so a
    version that landed since beats all that landed before. An index tells which months hold touched
    invoices; those months and the ones that now get them are rewritten.
    """
    table = "fact_invoices"
    index = KeyIndex(store, ANALYTICS, table, "invoice_id", MONTH)

    month_of_issue = month_start(F.to_date("issued_at"))

    def finished(df: DataFrame) -> DataFrame:
        return finish(df.drop(MONTH)).withColumn(MONTH, month_of_issue)

    if full_refresh or not store.exists(ANALYTICS, table):
        with durable_copy(stage(landed)) if staged is None else nullcontext(staged) as rows:
            content, large = rebuild(rows), is_large(rows)
            if large:  # Neighbouring keys take less room.
                content = content.sortWithinPartitions(month_of_issue, "invoice_id")
            else:
                content = content.withColumn(MONTH, month_of_issue)
            whole = store.replace(content, ANALYTICS, table, [MONTH], finished, in_place=large).drop(MONTH)
        index.rebuild()
        return whole
    mark = incremental.read_watermark(store.read(ANALYTICS, table))
    fresh = landed.filter(incremental.ingested_after("_ingested_at", mark))
    with durable_copy(stage(fresh)) as rows, durable_parts(finished(rebuild(rows)), MONTH) as (rebuilt, rebuilt_in):
        with index.following(rebuilt) as (months, held_in):
            merge_partitions(store, ANALYTICS, table, rebuilt_in, held_in, "invoice_id", MONTH, months)
    return store.read(ANALYTICS, table).drop(MONTH)


def refresh_history(
    store: Store, table: str, source: DataFrame, key: str, run_at: datetime, buckets: int = BUCKETS
) -> DataFrame:
    """SCD-01..03 stored: one table whose partitions are buckets of open versions and closed versions by run.

    Hashes of the rows tell which buckets a run changes; only those are rewritten, together with the
    versions the run closes, in one replacement of partitions. So a run counts as a whole or not at
    all, and repeating it changes nothing.
    """
    bucket = F.concat(F.lit(OPEN), bucket_of(key, buckets))
    if not store.exists(SNAPSHOTS, table):
        first = history.first_history(source).withColumn(PART, bucket)
        store.replace(first, SNAPSHOTS, table, [PART], in_place=is_large(source))
        return read_history(store, table)
    store.recover(SNAPSHOTS, table)
    current = store.read(SNAPSHOTS, table).filter(F.col(PART).startswith(OPEN))
    columns = [c for c in current.columns if c != PART]
    with durable_copy(history.merge_current(current.drop(PART), source, key, run_at)) as merged:
        opened = history.current_versions(merged).withColumn(PART, bucket)
        before, after = (_part_hashes(rows, columns) for rows in (current, opened))
        differs = ~F.col("before").eqNullSafe(F.col("after"))
        both = before.withColumnRenamed("rows", "before").join(after.withColumnRenamed("rows", "after"), PART, "full_outer")
        # At most one row per bucket.
        changed = [r[PART] for r in both.filter(differs).collect()]
        if changed:
            closed = merged.filter(F.col(history.TO).isNotNull()).withColumn(PART, F.lit(_next_closed(store, table)))
            rows = opened.filter(F.col(PART).isin(changed)).unionByName(closed)
            store.replace_partitions(rows, SNAPSHOTS, table, PART, changed)
    return read_history(store, table)


def _part_hashes(rows: DataFrame, columns: list[str]) -> DataFrame:
    content = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("hash"))
    return rows.groupBy(PART).agg(content.alias("rows"))


def _next_closed(store: Store, table: str) -> str:
    parts = store.partitions(SNAPSHOTS, table)
    return f"{CLOSED}{1 + sum(name.startswith(f'{PART}={CLOSED}') for name in parts):06d}"


def read_history(store: Store, table: str) -> DataFrame:
    """All versions of a stored history."""
    return store.read(SNAPSHOTS, table).drop(PART)


SUBSCRIPTION_HISTORY = (
    "subscription_id", "user_id", "organization_id", "plan_name", "is_plan_missing", "billing_interval", "status",
    "is_status_unknown", "currency", "is_currency_recognized", "subscription_amount", "started_at",
    "trial_started_at", "trial_ended_at", "cancelled_at", "current_period_start", "current_period_end", "updated_at",
)
ACCOUNT_HISTORY = (
    "crm_account_id", "organization_id", "account_status", "is_account_status_unknown", "segment", "owner_team",
    "lead_source", "is_lead_source_missing", "created_at", "updated_at",
)


def together(writes: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Start independent writes at once, so that small ones fill the cluster beside big ones."""
    with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
        running = {name: pool.submit(write) for name, write in writes.items()}
        return {name: job.result() for name, job in running.items()}


def _days_of(lazy: Warehouse, source: str) -> Callable[[list], DataFrame] | None:
    """The staged rows of some days, where the source landed by day."""
    if not lazy.lands_by(source, DAY):
        return None
    return lambda days: lazy.landed_days(source, DAY, days).table(f"stg_{source}")


def build(store: Store, lazy: Warehouse, full_refresh: bool = False) -> Warehouse:
    """SNK-04: bring every stored table up to date and return the warehouse that reads them.

    ``lazy`` is the warehouse over the landed tables. Entities are staged to typed tables, since
    many models read them; events stay plans over the landed files, which only their fact reads.
    """
    as_of = lazy.as_of

    def whole(warehouse: Warehouse, layer: str, names) -> dict[str, Callable[[], DataFrame]]:
        return {n: lambda n=n: store.replace(warehouse.table(n), layer, n) for n in names}

    staged = lazy.with_stored(together(whole(lazy, STAGING, STORED_STAGING)))
    users, organizations, subscriptions = staged.stg_users, staged.stg_organizations, staged.stg_subscriptions

    def invoice_rows(rows: DataFrame) -> DataFrame:
        return facts.matched_invoices(rows, subscriptions, organizations)

    def product_rows(rows: DataFrame) -> DataFrame:
        return facts.matched_product_usage(rows, users, organizations)

    def api_rows(rows: DataFrame) -> DataFrame:
        return facts.matched_api_usage(rows, organizations)

    base = {
        **whole(staged, ANALYTICS, DIMENSIONS),
        "fact_subscriptions": lambda: store.replace(
            facts.stored_subscriptions(subscriptions, users, organizations, as_of), ANALYTICS, "fact_subscriptions"
        ),
        "fact_invoices": lambda: refresh_invoices(
            store, lazy.raw("invoices"), lambda rows: staging.invoices(rows, lazy.unique_raw), invoice_rows,
            full_refresh, staged.stg_invoices, facts.finished_invoices,
        ),
        "fact_product_usage": lambda: refresh_daily_fact(
            store, "fact_product_usage", staged.stg_product_events, "event_timestamp", "event_count", product_rows,
            full_refresh, _days_of(lazy, "product_events"), "product_events", facts.keyed_product_usage,
        ),
        "fact_api_usage": lambda: refresh_daily_fact(
            store, "fact_api_usage", staged.stg_api_usage, "request_timestamp", "request_count", api_rows,
            full_refresh, _days_of(lazy, "api_usage"), "api_usage", facts.keyed_api_usage,
        ),
        "snap_subscriptions": lambda: refresh_history(
            store, "snap_subscriptions", subscriptions.select(*SUBSCRIPTION_HISTORY), "subscription_id", as_of
        ),
        "snap_crm_accounts": lambda: refresh_history(
            store, "snap_crm_accounts", staged.stg_crm_accounts.select(*ACCOUNT_HISTORY), "crm_account_id", as_of
        ),
    }
    # Marts read the stored tables instead of computing them again; one mart reads two others.
    stored = staged.with_stored(together(base))
    first = stored.with_stored(together(whole(stored, ANALYTICS, [m for m in MARTS if m != "mart_customer_ltv"])))
    return first.with_stored(together(whole(first, ANALYTICS, ["mart_customer_ltv"])))


def landed_warehouse(store: Store, as_of: datetime) -> Warehouse:
    """Models over the landed tables. The upsert left one row per key, so staging need not sort for
    duplicates again."""
    return Warehouse({name: store.read(RAW, name) for name in SOURCES}, as_of, unique_raw=True)
