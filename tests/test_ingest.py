import json
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterbook.sources import audit, ingest
from meterbook.sources.readers import read_source
from meterbook.sources.registry import INGESTION_ORDER, SOURCES
from tests.helpers import rows

NOW = datetime(2024, 6, 1)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


ORGANIZATIONS = """organization_id,organization_name,domain,country_code,organization_type,created_at,updated_at
o1,First,a.example,US,startup,2024-01-01T00:00:00Z,2024-01-01T00:00:00Z
o2,"Two ""quoted""
lines",b.example,NA, business ,2024-01-02T00:00:00Z,2024-01-02T00:00:00Z
o3,,,,,,
o1,First again,a.example,US,startup,2024-01-01T00:00:00Z,2024-03-01T00:00:00Z
,Nobody,c.example,DE,startup,2024-01-01T00:00:00Z,2024-01-01T00:00:00Z
o4,Bad time,d.example,DE,startup,not a date,2024-01-01T00:00:00Z
"""


def test_csv_run(store, tmp_path):
    folder = write(tmp_path / "in", "organizations.csv", ORGANIZATIONS)
    run = ingest.ingest_source(store, SOURCES["organizations"], folder, NOW)
    assert (run.rows_received, run.rows_inserted, run.rows_updated, run.rows_rejected) == (6, 3, 0, 3)
    assert run.status == audit.PARTIAL
    landed = {r["organization_id"]: r for r in store.read("raw", "organizations").collect()}
    assert landed["o1"]["organization_name"] == "First again"
    assert landed["o2"]["organization_name"] == 'Two "quoted"\nlines'
    assert landed["o2"]["country_code"] == "NA" and landed["o2"]["organization_type"] == " business "
    assert landed["o3"]["organization_name"] is None
    assert landed["o1"]["_source_file"] == "organizations.csv" and landed["o1"]["_ingested_at"] == NOW
    rejects = {r["reason"]: r for r in store.read("monitoring", "rejected_records").collect()}
    assert set(rejects) == {
        "Value error, missing required technical identifier: organization_id",
        "Value error, Unknown string format: not a date",
        "duplicate business key within source file",
    }
    assert json.loads(rejects["duplicate business key within source file"]["raw_payload"])["organization_name"] == "First"


def test_same_file_again_inserts_nothing(store, tmp_path):
    folder = write(tmp_path / "in", "organizations.csv", "\n".join(ORGANIZATIONS.splitlines()[:2]) + "\n")
    first = ingest.ingest_source(store, SOURCES["organizations"], folder, NOW)
    second = ingest.ingest_source(store, SOURCES["organizations"], folder, datetime(2024, 6, 2))
    assert (first.rows_inserted, first.rows_updated) == (1, 0)
    assert (second.rows_inserted, second.rows_updated, second.status) == (0, 1, audit.SUCCESS)
    assert store.read("raw", "organizations").count() == 1
    assert rows(store.read("raw", "organizations"), "_ingested_at") == [(datetime(2024, 6, 2),)]


def test_csv_columns_go_by_name(store, tmp_path):
    text = "updated_at,organization_id,surplus,organization_name\n2024-01-01,o1,x,First\n"
    run = ingest.ingest_source(store, SOURCES["organizations"], write(tmp_path / "in", "organizations.csv", text), NOW)
    assert run.status == audit.SUCCESS
    assert rows(store.read("raw", "organizations"), "organization_id", "organization_name", "domain", "updated_at") == [
        ("o1", "First", None, "2024-01-01")
    ]


EVENTS = "\n".join(
    [
        '{"event_id": "e1", "user_id": "u1", "event_timestamp": "2024-05-01T10:00:00Z", "properties": {"value": 1}}',
        "",
        '{"event_id": "e2", "event_timestamp": "2024-05-01T10:00:00Z", "event_id": "e2b"}',
        "this is not json",
        '{"event_id": "e3", "event_timestamp": "2024-05-01T10:00:00Z"} trailing',
        '{"event_id": "e4"',
        "[1, 2]",
        '{"event_id": 5, "event_timestamp": " "}',
        '{"event_id": "  ", "event_timestamp": "2024-05-01"}',
        '{"event_id": "e6", "event_timestamp": "yesterday-ish"}',
        '{"event_id": "e7", "event_timestamp": "2024-05-01"},"x":1',
    ]
)


def test_jsonl_run(store, tmp_path):
    folder = write(tmp_path / "in", "product_events.jsonl", EVENTS + "\n")
    run = ingest.ingest_source(store, SOURCES["product_events"], folder, NOW)
    assert (run.rows_received, run.rows_inserted, run.rows_rejected) == (10, 2, 8)
    landed = {r["event_id"]: r for r in store.read("raw", "product_events").collect()}
    assert set(landed) == {"e1", "e2b"}
    assert json.loads(landed["e1"]["properties"]) == {"value": 1}
    reasons = sorted(r["reason"] for r in store.read("monitoring", "rejected_records").collect())
    assert reasons.count("malformed JSON") == 4
    assert reasons.count("line is not a JSON object") == 1
    assert (
        "Input should be a valid string; Value error, missing required timestamp: event_timestamp" in reasons
    )
    assert "Value error, Unknown string format: yesterday-ish" in reasons


def test_malformed_line_is_kept_whole(store, tmp_path):
    folder = write(tmp_path / "in", "product_events.jsonl", "x" * 900 + "\n")
    ingest.ingest_source(store, SOURCES["product_events"], folder, NOW)
    payload = store.read("monitoring", "rejected_records").first()["raw_payload"]
    assert json.loads(payload) == {"raw_line": "x" * 900}


def test_parquet_values_become_text(spark, tmp_path):
    table = pa.table(
        {
            "request_id": ["r1", "r2"],
            "request_timestamp": ["2024-05-01T10:00:00Z"] * 2,
            "latency_ms": [120, None],
            "estimated_cost": [0.5, float("nan")],
        }
    )
    pq.write_table(table, tmp_path / "api_usage.parquet")
    df = read_source(spark, SOURCES["api_usage"], str(tmp_path / "api_usage.parquet"))
    assert rows(df, "request_id", "latency_ms", "estimated_cost", "endpoint") == [
        ("r1", "120", "0.5", None),
        ("r2", None, None, None),
    ]


def test_last_row_wins_without_a_version(store, tmp_path):
    text = "invoice_id,subscription_id,customer_id,currency,subtotal,tax,total,status,issued_at,paid_at\n"
    text += "".join(f"i1,s,c,USD,1,0,{n},open,2024-01-01,\n" for n in range(5))
    folder = write(tmp_path / "in", "invoices.csv", text)
    run = ingest.ingest_source(store, SOURCES["invoices"], folder, NOW)
    assert run.rows_rejected == 4
    assert rows(store.read("raw", "invoices"), "total") == [("4",)]
    assert ingest.ingest_source(store, SOURCES["invoices"], folder, NOW).rows_updated == 1
    assert rows(store.read("raw", "invoices"), "total") == [("4",)]


def test_events_delivered_again_rewrite_only_their_days(store, tmp_path):
    def deliver(name, *events):
        lines = [json.dumps({"event_id": i, "event_timestamp": t, "event_name": n}) for i, t, n in events]
        folder = write(tmp_path / name, "product_events.jsonl", "\n".join(lines) + "\n")
        return ingest.ingest_source(store, SOURCES["product_events"], folder, NOW)

    def files(day):
        found = store.read("raw", "product_events").filter(F.col("_day") == day).select("_metadata.file_path")
        return {r[0] for r in found.collect()}

    deliver("a", ("e1", "2024-05-01", "x"), ("e2", "2024-05-02", "x"), ("e3", "2024-05-03", "x"))
    untouched = files("2024-05-03")
    added = deliver("b", ("e4", "2024-05-03", "x"))
    assert (added.rows_inserted, added.rows_updated) == (1, 0)
    assert untouched < files("2024-05-03")
    third = files("2024-05-03")
    run = deliver("c", ("e1", "2024-05-01", "again"), ("e5", "2024-05-01", "x"))
    assert (run.rows_inserted, run.rows_updated) == (1, 1)
    assert files("2024-05-03") == third
    # an event moves, and its old day becomes empty
    deliver("d", ("e2", "2024-05-03", "moved"))
    assert rows(store.read("raw", "product_events"), "event_id", "event_name", "event_timestamp") == [
        ("e1", "again", "2024-05-01"),
        ("e2", "moved", "2024-05-03"),
        ("e3", "x", "2024-05-03"),
        ("e4", "x", "2024-05-03"),
        ("e5", "x", "2024-05-01"),
    ]


def test_missing_file_leaves_a_failed_run(store, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.ingest_source(store, SOURCES["users"], str(tmp_path), NOW)
    run = audit.runs(store).first()
    assert run["status"] == audit.FAILED and "source file not found" in run["error_message"]


def test_only_rejects_is_failed_and_empty_is_success(store, tmp_path):
    header = ",".join(SOURCES["users"].columns) + "\n"
    bad = write(tmp_path / "bad", "users.csv", header + "," * (len(SOURCES["users"].columns) - 1) + "x\n")
    assert ingest.ingest_source(store, SOURCES["users"], bad, NOW).status == audit.FAILED
    empty = write(tmp_path / "empty", "users.csv", header)
    assert ingest.ingest_source(store, SOURCES["users"], empty, NOW).status == audit.SUCCESS


def test_all_sources_go_on_after_a_failure_and_are_reported(store, tmp_path):
    folder = write(tmp_path / "in", "organizations.csv", ORGANIZATIONS)
    results = dict(ingest.ingest_all(store, folder, NOW, ("users", "organizations")))
    assert isinstance(results["users"], FileNotFoundError)
    report = ingest.ingestion_report(store).first()
    assert (report["source"], report["raw_row_count"], report["duplicate_keys"], report["null_keys"]) == (
        "organizations", 3, 0, 0,
    )
    assert report["cumulative_rows_rejected"] == 3
    assert INGESTION_ORDER[0] == "organizations" and len(INGESTION_ORDER) == 8


def test_a_dead_replacement_is_not_read(store, spark):
    store.replace(spark.range(3), "raw", "t")
    spark.range(9).write.parquet(store.path("raw", "t", 2))
    files, where = store._files(store.path("raw", "t", 2) + "/_SUCCESS")
    files.delete(where, False)
    assert store.read("raw", "t").count() == 3
    store.replace(spark.range(5), "raw", "t")
    assert store.version("raw", "t") == 2 and store.read("raw", "t").count() == 5


def test_reject_count_reconciles(store, tmp_path):
    folder = write(tmp_path / "in", "organizations.csv", ORGANIZATIONS)
    run = ingest.ingest_source(store, SOURCES["organizations"], folder, NOW)
    assert run.rows_received == run.rows_inserted + run.rows_updated + run.rows_rejected
    stored = store.read("monitoring", "rejected_records").filter(F.col("run_id") == run.run_id).count()
    assert stored == run.rows_rejected


def test_replacement_that_breaks_off_loses_nothing(spark, store, monkeypatch):
    rows = spark.createDataFrame([(d, i) for d in range(4) for i in range(5)], "day int, id int")
    store.replace(rows, "raw", "t", ["day"])
    new = spark.createDataFrame([(1, 100), (2, 200)], "day int, id int")

    def dies(path):
        store._delete(f"{path}/day=1")  # the old partition is gone, the new one isn't there yet
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_move_in", dies)
    with pytest.raises(RuntimeError):
        store.replace_partitions(new, "raw", "t", "day", [1, 2, 3])
    monkeypatch.undo()
    expected = {(0, i) for i in range(5)} | {(1, 100), (2, 200)}

    def held():
        return {tuple(r) for r in store.read("raw", "t").select("day", "id").collect()}

    redo = store.path("raw", "t", 1) + ".redo"
    assert held() == expected and store.path_exists(redo)  # a reader repairs nothing
    store.recover("raw", "t")
    assert held() == expected and not store.path_exists(redo)


def test_reading_during_a_replacement_leaves_it_alone(spark, store, monkeypatch):
    store.replace(spark.createDataFrame([(d, i) for d in (0, 1, None) for i in range(2)], "day int, id int"), "raw", "t", ["day"])
    whole, seen = store._move_in, []

    def read_first(path):
        seen.append(sorted((tuple(r) for r in store.read("raw", "t").select("day", "id").collect()), key=str))
        whole(path)

    monkeypatch.setattr(store, "_move_in", read_first)
    store.replace_partitions(spark.createDataFrame([(1, 7)], "day int, id int"), "raw", "t", "day", [1, None])
    assert seen == [[(0, 0), (0, 1), (1, 7)]]
    assert rows(store.read("raw", "t"), "day", "id") == seen[0]


def test_an_updated_entity_rewrites_one_bucket(store, tmp_path):
    header = ",".join(SOURCES["users"].columns)

    def deliver(name, now, *keys):
        lines = [header, *(f"{k},o1,a@b.example,US,2024-01-01,web,{name},2024-01-01,2024-01-0{now}" for k in keys)]
        folder = write(tmp_path / name, "users.csv", "\n".join(lines) + "\n")
        return ingest.ingest_source(store, SOURCES["users"], folder, datetime(2024, 6, now))

    def files():
        return {r[0] for r in store.read("raw", "users").select("_metadata.file_path").collect()}

    keys = [f"u{i}" for i in range(200)]
    deliver("a", 1, *keys)
    before = files()
    run = deliver("b", 2, "u7", "new")
    assert (run.rows_inserted, run.rows_updated) == (1, 1)
    landed = store.read("raw", "users")
    buckets = landed.filter("user_id in ('u7', 'new')").select("_bucket").distinct().count()
    assert len(before - files()) == buckets and len(before) > 10
    assert rows(landed.filter("status = 'b'"), "user_id") == [("new",), ("u7",)] and landed.count() == 201


def test_a_delivery_is_scanned_once_and_only_repeated_keys_are_joined(spark, store, tmp_path, monkeypatch):
    seen = []
    settle = ingest.settled

    def watched(checked, repeated, spec):
        outcome = settle(checked, repeated, spec)
        seen.append((repeated.count(), outcome._jdf.queryExecution().executedPlan().toString(), checked.inputFiles()))
        return outcome

    monkeypatch.setattr(ingest, "settled", watched)
    folder = write(tmp_path / "in", "organizations.csv", ORGANIZATIONS)
    ingest.ingest_source(store, SOURCES["organizations"], folder, NOW)
    lines = ORGANIZATIONS.splitlines()
    ingest.ingest_source(store, SOURCES["organizations"], write(tmp_path / "once", "organizations.csv", "\n".join(lines[:2]) + "\n"), NOW)
    (repeated, plan, files), (none, simple, _) = seen
    # The plan reads the stored copy and the list of repeated keys, not the delivery.
    assert repeated == 1 and plan.count("FileScan parquet") == 2 and "FileScan csv" not in plan
    assert none == 0 and "Join" not in simple and simple.count("FileScan") == 1
    assert all("durable" in f for f in files)


def test_the_log_finds_days_without_an_aggregate_of_all_rows(spark, store, tmp_path):
    from meterbook.plans import build
    from meterbook.sources import touched

    def deliver(name, now, *requests):
        columns = SOURCES["api_usage"].columns
        data = [{**dict.fromkeys(columns), "request_id": i, "request_timestamp": t, "organization_id": "o1"} for i, t in requests]
        frame = spark.createDataFrame([tuple(r[c] for c in columns) for r in data], SOURCES["api_usage"].schema)
        frame.write.parquet(str(tmp_path / name / "api_usage.parquet"))
        ingest.ingest_source(store, SOURCES["api_usage"], str(tmp_path / name), now)

    wanted = []

    def refresh():
        from meterbook.plans import facts, staging

        landed = store.read("raw", "api_usage")

        def days(found):
            wanted.append(sorted(found))
            return staging.api_usage(landed.filter(F.col("_day").isin(found)), unique=True)

        organizations = spark.createDataFrame([("o1",)], "organization_id string")
        fact = build.refresh_daily_fact(
            store, "fact_api_usage", staging.api_usage(landed, unique=True), "request_timestamp", "request_count",
            lambda rows: facts.fact_api_usage(rows, organizations), False, days, "api_usage",
        )
        return rows(fact, "date_day", "request_count")

    d = lambda n: datetime(2024, 5, n).date()
    deliver("a", datetime(2024, 6, 1), ("r1", "2024-05-01"), ("r2", "2024-05-02"), ("r3", "2024-05-03"))
    assert refresh() == [(d(1), 1), (d(2), 1), (d(3), 1)]
    # one moves and leaves its day empty, one is new on another day
    deliver("b", datetime(2024, 7, 1), ("r2", "2024-05-09"), ("r4", "2024-05-01"))
    assert refresh() == [(d(1), 2), (d(3), 1), (d(9), 1)]
    deliver("c", datetime(2024, 8, 1), ("r5", "2024-05-20"))
    assert refresh() == [(d(1), 2), (d(20), 1), (d(3), 1), (d(9), 1)]
    # the lookback takes in the delivery before, not all that ever landed
    assert wanted == [[d(1), d(2), d(3), d(9)], [d(1), d(2), d(9), d(20)]]
    days = touched.days_touched(store, "api_usage", datetime(2024, 6, 28))
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(inge" in plan and plan.count("FileScan") == 1
    scan = staging_plan(spark, store, [d(1)])
    assert "PartitionFilters: [_day" in scan or "PartitionFilters: [isnotnull(_day" in scan


def staging_plan(spark, store, days):
    from meterbook.plans import staging

    rows = staging.api_usage(store.read("raw", "api_usage").filter(F.col("_day").isin(days)), unique=True)
    return rows._jdf.queryExecution().executedPlan().toString()


def test_a_history_run_rewrites_only_buckets_that_change(spark, store, monkeypatch):
    from meterbook.plans import build

    def source(*changed):
        rows = [(f"k{i}", "new" if f"k{i}" in changed else "old", datetime(2024, 3 if f"k{i}" in changed else 1, 1)) for i in range(100)]
        return spark.createDataFrame(rows, "k string, status string, updated_at timestamp")

    def files(part):
        found = store.read("snapshots", "h").filter(F.col("_part").startswith(part)).select("_metadata.file_path")
        return {r[0] for r in found.collect()}

    build.refresh_history(store, "h", source(), "k", NOW)
    first = files("open-")
    build.refresh_history(store, "h", source(), "k", NOW)
    assert files("open-") == first and not files("closed-")
    build.refresh_history(store, "h", source("k7"), "k", NOW)
    second, closed = files("open-"), files("closed-")
    assert len(first - second) == 1 and len(closed) == 1
    build.refresh_history(store, "h", source("k7").filter("k <> 'k9'"), "k", NOW)
    assert closed < files("closed-") and len(second - files("open-")) == 1
    versions = build.read_history(store, "h")
    assert rows(versions.filter("k in ('k7', 'k9')"), "k", "status", "valid_from", "valid_to") == [
        ("k7", "new", datetime(2024, 3, 1), None), ("k7", "old", datetime(2024, 1, 1), datetime(2024, 3, 1)),
        ("k9", "old", datetime(2024, 1, 1), NOW),
    ]
    assert versions.count() == 101


def test_first_delivery_is_not_joined_with_itself(store, tmp_path, monkeypatch):
    """The days of a table's first rows follow from these rows; a replacing delivery looks up the days it leaves."""
    targets, find = [], ingest.touched_partitions

    def recorded(target, *rest):
        targets.append(target)
        return find(target, *rest)

    monkeypatch.setattr(ingest, "touched_partitions", recorded)
    requests = SOURCES["api_usage"]
    for i, day in enumerate(("2024-01-01", "2024-01-02")):
        folder = tmp_path / str(i)
        folder.mkdir()
        row = {c: None for c in requests.columns} | {"request_id": "r1", "request_timestamp": f"{day}T00:00:00Z"}
        pq.write_table(pa.table({c: pa.array([v], pa.string()) for c, v in row.items()}), str(folder / requests.file_name))
        ingest.ingest_source(store, requests, str(folder), NOW)
    assert [t is None for t in targets] == [True, False]
    logged = {(r["run_id"], str(r["day"])) for r in store.read("monitoring", "touched_days").collect()}
    assert sorted(d for _, d in logged) == ["2024-01-01", "2024-01-01", "2024-01-02"]
    assert [str(r["_day"]) for r in store.read("raw", "api_usage").collect()] == ["2024-01-02"]
