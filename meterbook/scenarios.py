"""The operators that write, run end to end over files and tables derived from the driver's data.

Landing, incremental refresh, history, quality runs, serving queries and the stream all leave
stored tables behind; each scenario works in a fresh folder under the shared one. Queries that read
the same built warehouse share it within a session.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators import history, incremental
from meterbook.operators.paging import Page
from meterbook.plans import build, facts, intermediate, metrics, reads, staging
from meterbook.plans.warehouse import Warehouse
from meterbook.quality import checks, declared, reconcile, rules, runner
from meterbook.session import durable, scratch_folder
from meterbook.sources import audit, ingest
from meterbook.sources.bindings import EVENT_AS_OF, EVENT_WINDOW_DAYS, SUBSCRIPTION_AS_OF, Bindings
from meterbook.sources.registry import SOURCES
from meterbook.sources.store import Store
from meterbook.streaming import daily_usage

LANDED_AT = datetime(2024, 2, 1)
LATE_AFTER = datetime(2024, 1, 15)
INVOICES_AFTER = datetime(2000, 1, 1)
HISTORY_RUN = datetime(2001, 1, 1)
VOLUME_CUT = datetime(1999, 6, 1)

_shared: dict[tuple, object] = {}


def _once(bindings: Bindings, name: str, make: Callable[[], object]):
    """Made on first use and kept for the session: the tables behind it are stored."""
    key = (bindings.spark.sparkContext.applicationId, bindings.folder, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def _new_store(b: Bindings, purpose: str) -> Store:
    return Store(b.spark, scratch_folder(b.spark, purpose))


# --- landing -------------------------------------------------------------------------------------


def _write_csv(df: DataFrame, source: str, folder: str) -> None:
    (
        df.select(*SOURCES[source].columns)
        .write.option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{folder}/{SOURCES[source].file_name}")
    )


def _number(column: str) -> Column:
    return F.regexp_extract(column, "([0-9]+)$", 1).cast("bigint")


def _deliver_accounts(b: Bindings, folder: str) -> None:
    """Both account deliveries in one file, some rows without an id or with an unreadable time."""
    n = _number("crm_account_id")
    dirty = b.crm_accounts().withColumns(
        {
            "created_at": F.when(n % 31 == 7, "not-a-date").otherwise(F.col("created_at")),
            "crm_account_id": F.when(n % 29 == 5, "  ").otherwise(F.col("crm_account_id")),
        }
    )
    _write_csv(dirty, "crm_accounts", folder)


def _deliver_events(b: Bindings, folder: str) -> None:
    """Events as JSON lines, with broken lines, lines that are no object, and repeated lines."""
    n = _number("event_id")
    columns = SOURCES["product_events"].columns
    events = b.product_events().withColumn("_n", n)
    blank_time = events.withColumn(
        "event_timestamp",
        F.when(F.col("_n") % 317 == 4, " ").otherwise(F.coalesce("event_timestamp", F.lit("2024-01-01"))),
    )
    record = F.to_json(F.struct(*columns))
    line = (
        F.when(F.col("_n") % 307 == 1, F.substring(record, 1, 20))
        .when(F.col("_n") % 311 == 2, "[1, 2]")
        .when(F.col("_n") % 331 == 5, "   ")
        .when(F.col("_n") % 313 == 3, F.to_json(F.struct(F.col("_n").alias("event_id"), "event_timestamp")))
        .otherwise(record)
    )
    copies = F.sequence(F.lit(1), F.when(F.col("_n") % 337 == 6, 2).otherwise(1))
    lines = blank_time.withColumn("_copy", F.explode(copies)).select(line.alias("value"))
    lines.write.text(f"{folder}/{SOURCES['product_events'].file_name}")


def _deliver_requests(b: Bindings, folder: str) -> None:
    """Requests as typed parquet: numbers, a NaN cost, and bad ids and times."""
    n = _number("request_id")
    typed = b.api_usage().select(
        F.when(n % 211 == 1, "").otherwise(F.col("request_id")).alias("request_id"),
        "user_id",
        "organization_id",
        "endpoint",
        "model_family",
        F.when(n % 223 == 2, "garbage").when(n % 227 != 3, F.col("request_timestamp")).alias("request_timestamp"),
        F.col("latency_ms").cast("bigint").alias("latency_ms"),
        F.col("input_units").cast("int").alias("input_units"),
        fn.safe_integer(F.col("output_units")).alias("output_units"),
        F.col("status_code").cast("smallint").alias("status_code"),
        F.when(n % 97 == 0, F.lit(float("nan"))).otherwise(F.col("input_units").cast("double")).alias("estimated_cost"),
    )
    typed.write.parquet(f"{folder}/{SOURCES['api_usage'].file_name}")


def _landed(b: Bindings) -> Store:
    def make() -> Store:
        store = _new_store(b, "landed")
        delivery = f"{store.root}/delivery"
        _deliver_accounts(b, delivery)
        _deliver_events(b, delivery)
        _deliver_requests(b, delivery)
        for name in ("crm_accounts", "product_events", "api_usage"):
            ingest.ingest_source(store, SOURCES[name], delivery, LANDED_AT)
        return store

    return _once(b, "landed", make)


def reject_reasons(b: Bindings) -> DataFrame:
    """SRC-01..03, VAL-01..06, SNK-02: why rows were rejected."""
    rejects = _landed(b).read(audit.LAYER, audit.REJECTS)
    return rejects.groupBy("source_name", "reason").agg(F.count("*").alias("rows"))


def landed_rows(source: str) -> Callable[[Bindings], DataFrame]:
    def read(b: Bindings) -> DataFrame:
        return _landed(b).read(ingest.RAW, source).select(*SOURCES[source].columns)

    return read


def landing_report(b: Bindings) -> DataFrame:
    """VAL-07..09: rows and keys per source beside the counts of its runs."""
    store = _landed(b)
    names = [n for n in SOURCES if store.exists(ingest.RAW, n)]
    status = audit.runs(store).select(F.col("source_name").alias("source"), "status")
    return (
        ingest.ingestion_report(store, names)
        .join(status, "source")
        .select(
            "source",
            "raw_row_count",
            "duplicate_keys",
            "null_keys",
            F.col("cumulative_rows_received").alias("rows_received"),
            F.col("cumulative_rows_inserted").alias("rows_inserted"),
            F.col("cumulative_rows_updated").alias("rows_updated"),
            F.col("cumulative_rows_rejected").alias("rows_rejected"),
            "status",
        )
    )


def landed_lineage(b: Bindings) -> DataFrame:
    """SNK-05: landed rows by the run that landed them, and how many of them name a file of the delivery."""
    store = _landed(b)
    runs = audit.runs(store).select(F.col("run_id").alias("_run_id"), "source_name", "status")
    named = F.count_if(F.col("_source_file").startswith("part-")).alias("rows_with_file")
    landed = [
        store.read(ingest.RAW, n).groupBy("_run_id", "_ingested_at").agg(F.count("*").alias("rows"), named)
        for n in SOURCES
        if store.exists(ingest.RAW, n)
    ]
    return reduce(DataFrame.unionByName, landed).join(runs, "_run_id").drop("_run_id")


def _upserted(b: Bindings) -> Store:
    """Three deliveries of accounts: those that stayed, all of them, and all of them again."""

    def make() -> Store:
        store = _new_store(b, "upserted")
        deliveries = [b.crm_second_delivery(), b.crm_first_delivery(), b.crm_first_delivery()]
        for i, rows in enumerate(deliveries):
            folder = f"{store.root}/delivery-{i}"
            _write_csv(rows, "crm_accounts", folder)
            ingest.ingest_source(store, SOURCES["crm_accounts"], folder, datetime(2024, 2, 1 + i))
        return store

    return _once(b, "upserted", make)


def upsert_runs(b: Bindings) -> DataFrame:
    """SNK-01, SNK-03: what each delivery inserted and replaced."""
    return audit.runs(_upserted(b)).select(
        "started_at", "status", "rows_received", "rows_inserted", "rows_updated", "rows_rejected"
    )


def upserted_accounts(b: Bindings) -> DataFrame:
    return _upserted(b).read(ingest.RAW, "crm_accounts").select(*SOURCES["crm_accounts"].columns, "_ingested_at")


# --- incremental facts ---------------------------------------------------------------------------


def _events_until(b: Bindings, moment: datetime) -> DataFrame:
    raw = b.product_events()
    return staging.product_events(raw.filter(F.col("_ingested_at") <= fn.time_literal(moment)))


def affected_days(b: Bindings) -> DataFrame:
    """INC-01, INC-02: the days that rows arriving after the first build belong to."""
    w = b.warehouse()
    first = intermediate.daily_product_usage(_events_until(b, LATE_AFTER), "date_day", with_ingest_time=True)
    days = incremental.affected_days(
        w.stg_product_events, "event_timestamp", "_ingested_at", incremental.watermark(first)
    )
    return days.withColumnRenamed("_day", "affected_day")


def usage_after_late_rows(b: Bindings) -> DataFrame:
    """INC-02: the fact of the first rows, brought up to date when the others have come."""
    w = b.warehouse()

    def rebuild(rows: DataFrame) -> DataFrame:
        return facts.fact_product_usage(rows, w.stg_users, w.stg_organizations)

    first = rebuild(_events_until(b, LATE_AFTER))
    return incremental.refresh_days(first, w.stg_product_events, rebuild, "event_timestamp")


def stored_api_usage_after_late_rows(b: Bindings) -> DataFrame:
    """INC-01, INC-02, INC-06 on the stored, day-partitioned fact."""
    w, store = b.warehouse(), _new_store(b, "api-usage")

    def rebuild(rows: DataFrame) -> DataFrame:
        return facts.fact_api_usage(rows, w.stg_organizations)

    early = staging.api_usage(b.api_usage().filter(F.col("_ingested_at") <= fn.time_literal(LATE_AFTER)))
    for rows in (early, w.stg_api_usage):
        build.refresh_daily_fact(store, "fact_api_usage", rows, "request_timestamp", "request_count", rebuild)
    return store.read(build.ANALYTICS, "fact_api_usage")


def invoices_after_update(b: Bindings) -> DataFrame:
    """INC-03 on the stored fact: invoices delivered again replace their rows."""
    w, store = b.warehouse(), _new_store(b, "invoices")
    # Both refreshes look these up: they are staged once.
    organizations = durable(w.stg_organizations.select("organization_id"))
    subscriptions = durable(staging.subscriptions(b.subscriptions(), reread=True).select(*intermediate.OWNER_COLUMNS))

    def rebuild(rows: DataFrame) -> DataFrame:
        return facts.matched_invoices(rows, subscriptions, organizations)

    early = b.invoices().filter(F.col("_ingested_at") <= fn.time_literal(INVOICES_AFTER))
    for landed in (early, b.invoices()):
        fact = build.refresh_invoices(store, landed, staging.invoices, rebuild, finish=facts.finished_invoices)
    return fact


def _requests_in_two_deliveries(b: Bindings) -> tuple[Store, DataFrame]:
    """Requests landed by two deliveries, and the fact refreshed after each. The first has a part of the
    requests, some under a wrong day; the second has the others, and corrects those."""

    def make() -> tuple[Store, DataFrame]:
        # Every refresh joins the organizations: they are staged once.
        store, organizations = _new_store(b, "deliveries"), durable(b.warehouse().stg_organizations)
        whole, n = b.api_usage().select(*SOURCES["api_usage"].columns), _number("request_id")
        wrong = F.date_format(F.col("request_timestamp").try_cast("timestamp") - F.expr("interval 40 days"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        first = whole.filter(n % 3 > 0).withColumn("request_timestamp", F.when(n % 50 == 1, wrong).otherwise(F.col("request_timestamp")))
        for i, rows in enumerate((first, whole.filter((n % 3 == 0) | (n % 50 == 1)))):
            now, folder = LANDED_AT + timedelta(days=10 * i), f"{store.root}/delivery-{i}"
            rows.write.parquet(f"{folder}/{SOURCES['api_usage'].file_name}")
            ingest.ingest_source(store, SOURCES["api_usage"], folder, now)
            fact = _refresh_requests(store, organizations)
        return store, fact

    return _once(b, "deliveries", make)


def _refresh_requests(store: Store, organizations: DataFrame, full_refresh: bool = False) -> DataFrame:
    landed = store.read(ingest.RAW, "api_usage")

    def days(wanted: list) -> DataFrame:
        return staging.api_usage(landed.filter(F.col(ingest.DAY).isin(wanted)), unique=True)

    return build.refresh_daily_fact(
        store, "fact_api_usage", staging.api_usage(landed, unique=True), "request_timestamp", "request_count",
        lambda rows: facts.fact_api_usage(rows, organizations), full_refresh, days, "api_usage",
    )


def landed_usage_refreshed(b: Bindings) -> DataFrame:
    """INC-01, INC-02: the fact after two deliveries, the second refresh led by the log of touched days."""
    return _requests_in_two_deliveries(b)[1].drop("_last_ingested_at")


def full_refresh_equals_incremental(b: Bindings) -> DataFrame:
    """INC-05: the requests of each day as refreshed and as built anew."""
    def make() -> DataFrame:
        store, refreshed = _requests_in_two_deliveries(b)
        kept = refreshed.groupBy("date_day").agg(F.sum("request_count").alias("refreshed_requests"))
        anew = _refresh_requests(store, b.warehouse().stg_organizations, full_refresh=True)
        anew = anew.groupBy("date_day").agg(F.sum("request_count").alias("rebuilt_requests"))
        return durable(kept.join(anew, "date_day", "full_outer"))

    return _once(b, "deliveries-anew", make)


# --- history -------------------------------------------------------------------------------------


def _accounts(raw: DataFrame) -> DataFrame:
    return staging.crm_accounts(raw).select(*build.ACCOUNT_HISTORY)


def account_history(b: Bindings) -> DataFrame:
    """SCD-02, SCD-03: two deliveries of accounts, some changed and some gone."""
    first = history.first_history(_accounts(b.crm_first_delivery()))
    return history.merge_history(first, _accounts(b.crm_second_delivery()), "crm_account_id", HISTORY_RUN)


def current_accounts(b: Bindings) -> DataFrame:
    """SCD-04."""
    return history.current_versions(account_history(b))


def previous_account_status(b: Bindings) -> DataFrame:
    """WN-08."""
    versions = history.previous_values(account_history(b), "crm_account_id", ["account_status", "segment"])
    return versions.select(
        "crm_account_id", "account_status", "previous_account_status", "previous_segment", "valid_from", "valid_to"
    )


def subscription_history(b: Bindings) -> DataFrame:
    """SCD-01 stored, run three times: as all were when they started, as they are, and once more."""
    store = _new_store(b, "history")
    now = b.warehouse().stg_subscriptions.select(*build.SUBSCRIPTION_HISTORY)
    early = now.filter(F.col("started_at") < fn.time_literal(INVOICES_AFTER)).withColumns(
        {"status": F.lit("trialing"), "is_status_unknown": F.lit(False), "updated_at": F.col("started_at")}
    )
    for source in (early, now, now):
        build.refresh_history(store, "snap_subscriptions", source, "subscription_id", SUBSCRIPTION_AS_OF)
    return build.read_history(store, "snap_subscriptions").select(
        "subscription_id", "status", "plan_name", "updated_at", "valid_from", "valid_to"
    )


# --- the built warehouse: quality and serving ----------------------------------------------------


def built(b: Bindings) -> tuple[Store, Warehouse]:
    """SNK-04: landed tables, all models and histories stored."""

    def make() -> tuple[Store, Warehouse]:
        store = _new_store(b, "warehouse")
        raw = b.raw()
        runs = [audit.start_run(store, name, SOURCES[name].file_name, LANDED_AT) for name in raw]
        # The log of runs has one writer at a time; the tables do not share one.
        # Rows in the order of their keys take less room: neighbouring keys share most of their letters.
        landed = build.together(
            {
                name: lambda n=name, r=rows: store.replace(r().sortWithinPartitions(SOURCES[n].key), build.RAW, n)
                for name, rows in raw.items()
            }
        )
        for run in runs:
            audit.finish_run(store, run, audit.SUCCESS, LANDED_AT)
        lazy = Warehouse(
            landed, SUBSCRIPTION_AS_OF, EVENT_AS_OF, EVENT_WINDOW_DAYS, activity=b.order_activity(), reread_raw=True
        )
        return store, build.build(store, lazy)

    return _once(b, "warehouse", make)


def _tables(b: Bindings) -> Callable[[str], DataFrame]:
    store, warehouse = built(b)

    def table(name: str) -> DataFrame:
        if name.startswith("raw_"):
            return store.read(build.RAW, name.removeprefix("raw_"))
        return build.read_history(store, name) if name.startswith("snap_") else warehouse.table(name)

    return table


def rule_counts(declared_rules: list[rules.Rule]) -> Callable[[Bindings], DataFrame]:
    """DQ-01..09."""
    return lambda b: rules.count_violations(declared_rules, _tables(b))


def orphaned_subscriptions(b: Bindings) -> DataFrame:
    """DQ-04 as a list of rows: subscriptions of users that do not exist."""
    rule = next(r for r in declared.STAGING_RULES if r.model == "stg_subscriptions" and r.columns == ("user_id",))
    table = _tables(b)
    return rules.violations(table(rule.model), rule, table).select("subscription_id", "user_id")


def reconciliation(b: Bindings) -> DataFrame:
    """DQ-10, DQ-11."""
    return reconcile.reconciliation(_tables(b))


def row_tests(b: Bindings) -> DataFrame:
    """DQ-12, DQ-13."""
    return reconcile.row_test_counts(_tables(b))


def _quality(b: Bindings) -> runner.QualityRun:
    store, warehouse = built(b)
    return _once(b, "quality", lambda: runner.run_checks(store, warehouse, EVENT_AS_OF))


def check_results(b: Bindings) -> DataFrame:
    """DQ-14..27: the outcomes of the whole catalog."""
    run = _quality(b)
    results = built(b)[0].read(runner.LAYER, runner.RESULTS)
    return results.filter(F.col("run_id") == run.run_id).select(
        "test_name", "category", "severity", "status", "failed_rows", "total_rows", "failure_rate"
    )


def run_status(b: Bindings) -> DataFrame:
    """DQ-28."""
    run = _quality(b)
    results = built(b)[0].read(runner.LAYER, runner.RESULTS).filter(F.col("run_id") == run.run_id)
    return runner.overall_status_by_run(results).select("overall_status")


def check_frequency(b: Bindings) -> DataFrame:
    """DQ-29."""
    run = _quality(b)
    results = built(b)[0].read(runner.LAYER, runner.RESULTS).filter(F.col("run_id") == run.run_id)
    return runner.check_frequency(results)


def _context(b: Bindings) -> checks.CheckContext:
    store, warehouse = built(b)
    return runner.store_context(store, warehouse, EVENT_AS_OF)


def source_freshness(b: Bindings) -> DataFrame:
    """DQ-22: the age of each landed table."""
    found = checks.raw_source_freshness(_context(b), checks.CheckConfig()).details
    rows = [(t, float(age), found["outcomes"][t]) for t, age in found["values"].items()]
    return b.spark.createDataFrame(rows, "source_table string, age_hours double, status string")


def watermark_lag(b: Bindings) -> DataFrame:
    """DQ-23: the lag of facts that only know rows up to a date."""
    whole = _context(b)
    late = {"analytics.fact_product_usage", "analytics.fact_api_usage"}

    def table(name: str) -> DataFrame:
        rows = whole.table(name)
        return rows.filter(F.col("_last_ingested_at") <= fn.time_literal(LATE_AFTER)) if name in late else rows

    found = checks.incremental_fact_watermarks(checks.CheckContext(table, EVENT_AS_OF), checks.CheckConfig()).details
    rows = [(t, float(lag), found["outcomes"][t] != checks.PASS) for t, lag in found["values"].items()]
    return b.spark.createDataFrame(rows, "fact_table string, lag_hours double, is_lagging boolean")


def volume_drop(b: Bindings) -> DataFrame:
    """DQ-26: the counts of what had landed by a date against the counts of all."""
    whole = _context(b)
    baseline = checks.row_count_volume_drop(checks.CheckContext(whole.table, EVENT_AS_OF), checks.CheckConfig())

    def early(name: str) -> DataFrame:
        return whole.table(name).filter(F.col("_ingested_at") <= fn.time_literal(VOLUME_CUT))

    context = checks.CheckContext(early, EVENT_AS_OF, lambda test: baseline.details)
    found = checks.row_count_volume_drop(context, checks.CheckConfig()).details
    rows = [(t, found["compared_with"][t], n, found["outcomes"][t]) for t, n in found["row_counts"].items()]
    return b.spark.createDataFrame(
        rows, "source_table string, previous_rows bigint, current_rows bigint, status string"
    )


def orphan_rates(b: Bindings) -> DataFrame:
    """DQ-17."""
    found = runner.run_catalog(_context(b), category="referential")
    rows = [(r.test_name, r.failed_rows, r.total_rows, float(r.failure_rate), r.status) for r in found]
    return b.spark.createDataFrame(
        rows, "test_name string, failed_rows bigint, total_rows bigint, failure_rate double, status string"
    )


def _served(query: Callable[[Warehouse], DataFrame | Page]) -> Callable[[Bindings], DataFrame]:
    def run(b: Bindings) -> DataFrame:
        answer = query(built(b)[1])
        return answer.rows if isinstance(answer, Page) else answer

    return run


def _customer_details(w: Warehouse) -> DataFrame:
    details = reads.customer_details(
        w.dim_organizations, w.fact_subscriptions, w.mart_customer_ltv, w.fact_product_usage, w.fact_api_usage,
        as_of=w.usage_as_of, window_days=w.window_days,
    )
    flat = details.select("*", F.explode_outer("revenue_by_currency").alias("line"))
    return flat.select(
        "organization_id", "organization_name", "organization_type", "is_enterprise", "country_code", "created_date",
        "line.currency", "line.active_monthly_recurring_revenue", "line.realized_ltv_to_date", "line.estimated_ltv",
        "usage_last_30_days.product_event_count", "usage_last_30_days.api_request_count",
    )


def latest_quality_run(b: Bindings) -> DataFrame:
    """QRY-15."""
    _quality(b)
    store = built(b)[0]
    return _flat_run(reads.latest_quality_run(store.read(runner.LAYER, runner.RUNS), store.read(runner.LAYER, runner.RESULTS)))


def quality_run_by_id(b: Bindings) -> DataFrame:
    """QRY-17: the run with the id that the run itself gave."""
    run, store = _quality(b), built(b)[0]
    runs, results = store.read(runner.LAYER, runner.RUNS), store.read(runner.LAYER, runner.RESULTS)
    return _flat_run(reads.quality_run_detail(runs, results, run.run_id))


def _flat_run(run: DataFrame) -> DataFrame:
    flat = run.select("overall_status", "total_checks", F.explode("results").alias("r"))
    return flat.select("overall_status", "total_checks", "r.category", "r.test_name", "r.severity", "r.status",
                       "r.failed_rows", "r.total_rows")


def quality_run_list(b: Bindings) -> DataFrame:
    """QRY-16."""
    _quality(b)
    runs = built(b)[0].read(runner.LAYER, runner.RUNS)
    return reads.quality_runs(runs).rows.select(
        "started_at", "overall_status", "total_checks", "passed_checks", "warned_checks", "failed_checks"
    )


def metric_lookup(b: Bindings) -> DataFrame:
    """QRY-18."""
    sources = metrics.MetricSources(built(b)[1])
    return metrics.lookup_metric(sources, "customer_ltv", limit=200, currency="eur").rows


# --- the stream ----------------------------------------------------------------------------------


def streamed_usage(b: Bindings) -> DataFrame:
    """STR-01: all landed events through the stream, in files that mix days and in several batches."""
    folder = scratch_folder(b.spark, "stream")
    b.product_events().repartition(4, "event_id").write.parquet(f"{folder}/arrivals")
    w = b.warehouse()
    # The fact looks up whether these keys are there. Staged once, not again with every batch.
    users, organizations = durable(w.stg_users.select("user_id")), durable(w.stg_organizations.select("organization_id"))
    stream = daily_usage.UsageStream(b.spark, folder, users, organizations)
    arrivals = (
        b.spark.readStream.schema(daily_usage.LANDED).option("maxFilesPerTrigger", 2).parquet(f"{folder}/arrivals")
    )
    daily_usage.start(stream, arrivals, f"{folder}/progress").awaitTermination()
    return stream.fact()


SCENARIOS: dict[str, Callable[[Bindings], DataFrame]] = {
    "ingest_reject_reasons": reject_reasons,
    "ingest_landed_accounts": landed_rows("crm_accounts"),
    "ingest_landed_events": landed_rows("product_events"),
    "ingest_landed_requests": landed_rows("api_usage"),
    "ingest_report": landing_report,
    "ingest_lineage": landed_lineage,
    "ingest_upsert_runs": upsert_runs,
    "ingest_upserted_accounts": upserted_accounts,
    "inc_affected_days": affected_days,
    "inc_fact_after_late_rows": usage_after_late_rows,
    "inc_stored_fact_after_late_rows": stored_api_usage_after_late_rows,
    "inc_invoices_after_update": invoices_after_update,
    "inc_landed_usage_refreshed": landed_usage_refreshed,
    "inc_full_refresh_equals_incremental": full_refresh_equals_incremental,
    "scd2_history": account_history,
    "scd2_current": current_accounts,
    "scd2_previous_status": previous_account_status,
    "scd2_subscription_history": subscription_history,
    "dq_rules_sources": rule_counts(declared.SOURCE_RULES),
    "dq_rules_staging": rule_counts(declared.STAGING_RULES),
    "dq_rules_intermediate": rule_counts(declared.INTERMEDIATE_RULES),
    "dq_rules_marts": rule_counts(declared.MART_RULES),
    "dq_rules_snapshots": rule_counts(declared.SNAPSHOT_RULES),
    "dq_orphaned_subscriptions": orphaned_subscriptions,
    "dq_reconciliation": reconciliation,
    "dq_row_tests": row_tests,
    "dq_orphan_rates": orphan_rates,
    "dq_freshness": source_freshness,
    "dq_watermark_lag": watermark_lag,
    "dq_volume_drop": volume_drop,
    "dq_check_results": check_results,
    "dq_overall_status": run_status,
    "dq_check_frequency": check_frequency,
    "qry_daily_growth": _served(lambda w: reads.daily_growth(w.mart_daily_growth, w.as_of.date())),
    "qry_acquisition_channels": _served(
        lambda w: reads.acquisition_channels(w.mart_acquisition_channels, "machinery")
    ),
    "qry_trial_conversion_page": _served(
        lambda w: reads.trial_conversion(w.mart_trial_conversion, is_converted=True, limit=50, offset=25)
    ),
    "qry_retention_cohorts": _served(
        lambda w: reads.retention_cohorts(w.mart_retention_cohorts, datetime(1995, 1, 1).date())
    ),
    "qry_mrr": _served(lambda w: reads.by_currency(w.mart_mrr, "usd")),
    "qry_arr": _served(lambda w: reads.by_currency(w.mart_arr)),
    "qry_churn_by_type": _served(lambda w: reads.churn(w.mart_customer_churn, "enterprise")),
    "qry_arpu": _served(lambda w: reads.by_currency(w.mart_arpu, "GBP")),
    "qry_customer_ltv_page": _served(
        lambda w: reads.customer_ltv(w.mart_customer_ltv, w.dim_organizations, limit=100, offset=50)
    ),
    "qry_feature_adoption": _served(lambda w: reads.feature_adoption(w.mart_feature_adoption, "click")),
    "qry_daily_usage_page": _served(
        lambda w: reads.daily_usage(w.fact_product_usage, w.usage_as_of.date(), limit=200, offset=100)
    ),
    "qry_api_usage_page": _served(
        lambda w: reads.api_usage(w.mart_api_usage, w.dim_organizations, w.usage_as_of.date(), limit=40, offset=5)
    ),
    "qry_customers_page": _served(lambda w: reads.customers(w.dim_organizations, "enterprise", limit=50, offset=10)),
    "qry_customer_detail": _served(_customer_details),
    "qry_quality_latest": latest_quality_run,
    "qry_quality_run_by_id": quality_run_by_id,
    "qry_quality_runs": quality_run_list,
    "qry_metric_lookup": metric_lookup,
    "stream_daily_usage": streamed_usage,
}
