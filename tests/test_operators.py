import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterbook.operators import history, incremental
from meterbook.operators.dedup import latest_per_key, mark_newest
from meterbook.operators.lookup import lookup
from meterbook.operators.paging import page, page_after
from meterbook.operators.spine import day_spine, observed_bounds, period_grid
from meterbook.operators.timeline import milestone_timeline
from meterbook.operators.upsert import upsert, upsert_counts
from meterbook.plans import intermediate, staging
from tests.helpers import event, raw, rows


def test_latest_per_key_against_brute_force(spark):
    rng = random.Random(1)
    # a third of all rows has one key
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.choice([None, 1, 2, 3]), i) for i in range(600)]
    df = spark.createDataFrame(data, "k string, v int, id int").repartition(4)
    want = {}
    for k, v, i in data:
        best = want.get(k)
        rank = (v is not None, v or 0, i)
        if best is None or rank > (best[0] is not None, best[0] or 0, best[1]):
            want[k] = (v, i)
    got = {r["k"]: (r["v"], r["id"]) for r in latest_per_key(df, ["k"], ["v"], ["id"]).collect()}
    assert got == want


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_mark_newest_by_version_then_position(spark):
    data = [("a", "2", 1), ("a", "3", 2), ("a", "3", 3), ("b", None, 4), ("b", "1", 5), ("c", None, 6)]
    df = spark.createDataFrame(data, "k string, version string, pos long")
    kept = {r["pos"] for r in mark_newest(df, "k", "version", ["pos"], "kept").filter("kept").collect()}
    assert kept == {3, 5, 6}
    last = {r["pos"] for r in mark_newest(df, "k", None, ["pos"], "kept").filter("kept").collect()}
    assert last == {3, 5, 6}


def test_lookup_keeps_every_row(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    got = rows(lookup(left, right, {"k": "k"}, take={"v": "v"}, matched="found"))
    assert got == [("a", 1, True), ("b", None, False), (None, None, False)]


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert rows(upsert(old, new, "k")) == [("a", 1), ("b", 20), ("c", 30)]
    assert tuple(upsert_counts(old, new, "k").first()) == (1, 1)


def test_timeline_orders_ties_by_milestone(spark):
    df = spark.createDataFrame(
        [("s", "2024-01-15", "2024-01-01", "2024-01-15", None)], "id string, s string, t string, e string, c string"
    ).select("id", *[F.col(c).cast("timestamp").alias(c) for c in "stec"])
    steps = {"trial": "t", "trial_end": "e", "start": "s", "cancel": "c"}
    got = rows(
        milestone_timeline(df, ["id"], steps),
        "transition_sequence", "transition_type", "previous_transition_type", "days_since_previous_transition",
    )
    assert got == [(1, "trial", None, None), (2, "trial_end", "trial", 14), (3, "start", "trial_end", 0)]


def test_day_spine_without_data_ends_at_as_of(spark):
    df = spark.createDataFrame([("2024-01-30",), (None,)], "d string").select(F.col("d").cast("timestamp").alias("d"))
    days = rows(day_spine(observed_bounds([(df, ["d"], [])], datetime(2024, 2, 2))))
    assert days[0] == (date(2024, 1, 30),) and len(days) == 4
    assert day_spine(observed_bounds([(df.filter("d is null"), ["d"], [])], datetime(2024, 2, 2))).count() == 0
    assert day_spine(observed_bounds([(df, ["d"], [])], datetime(2024, 1, 1))).count() == 0


def test_period_grid_lists_observable_months_only(spark):
    months = spark.createDataFrame([(date(2024, 1, 1),), (date(2020, 1, 1),)], "m date")
    grid = period_grid(months, "m", F.lit(date(2024, 3, 1)))
    assert grid.filter("m = '2024-01-01'").count() == 3
    assert grid.filter("m = '2020-01-01'").count() == 25


def test_pages_against_brute_force(spark):
    values = [((i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(values, "a int, b int").repartition(5)
    order = [F.col("a").asc_nulls_last(), F.col("b").asc()]
    want = sorted(values)
    assert [tuple(r) for r in page(df, order, 20, 30).rows.collect()] == want[30:50]
    deep = page(df, order, 20, 777)
    assert [tuple(r) for r in deep.rows.collect()] == want[777:797]
    assert [tuple(r) for r in page_after(df, ["a", "b"], want[776], 20).collect()] == want[777:797]
    assert deep.total() == 1000
    assert page(df, order, 20, 5000).rows.count() == 0
    for limit, offset in ((0, 0), (201, 0), (10, -1)):
        with pytest.raises(ValueError):
            page(df, order, limit, offset)


def _source(spark, *data):
    df = spark.createDataFrame(list(data), "k string, status string, updated_at string")
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp"))


def test_history_closes_changes_and_deletes(spark):
    one = _source(spark, ("a", "trial", "2024-01-01"), ("b", "x", "2024-01-01"), ("c", "x", "2024-01-01"), ("e", "x", None))
    two = _source(spark, ("a", "paid", "2024-02-01"), ("b", "changed", "2024-01-01"), ("d", "new", "2024-02-02"), ("e", "y", None))
    run = datetime(2024, 3, 1)
    merged = history.merge_history(history.first_history(one), two, "k", run)
    t = datetime
    assert rows(merged, "k", "status", "valid_from", "valid_to") == sorted(
        [
            ("a", "trial", t(2024, 1, 1), t(2024, 2, 1)),
            ("a", "paid", t(2024, 2, 1), None),
            ("b", "x", t(2024, 1, 1), None),  # an unchanged updated_at makes no version
            ("c", "x", t(2024, 1, 1), run),  # gone from the source
            ("d", "new", t(2024, 2, 2), None),
            ("e", "x", None, None),  # a missing updated_at makes none either
        ],
        key=str,
    )
    assert history.current_versions(merged).groupBy("k").count().filter("count > 1").count() == 0
    again = history.merge_history(merged, two, "k", datetime(2024, 4, 1))
    assert rows(again) == rows(merged)
    assert rows(history.malformed_intervals(merged), "k") == [("e",)]
    previous = history.previous_values(merged, "k", ["status"]).filter("k = 'a'")
    assert rows(previous, "status", "previous_status") == [("paid", "trial"), ("trial", None)]


def _usage(df):
    return intermediate.daily_product_usage(staging.product_events(df), "date_day", with_ingest_time=True)


def test_late_event_is_added_once(spark):
    first = raw(spark, "product_events", event("e1", "2024-05-01T10:00:00Z"))
    later = raw(
        spark,
        "product_events",
        event("e1", "2024-05-01T10:00:00Z"),
        event("e2", "2024-05-01T11:00:00Z", _ingested_at="2024-05-20 00:00:00"),
    )

    def refresh(target, landed):
        return incremental.refresh_days(
            target,
            staging.product_events(landed),
            lambda df: intermediate.daily_product_usage(df, "date_day", with_ingest_time=True),
            "event_timestamp",
        )

    target = _usage(first)
    assert rows(target, "event_count") == [(1,)]
    once = refresh(target, later)
    assert rows(once, "event_count") == [(2,)]
    assert rows(refresh(once, later), "event_count") == [(2,)]
    assert rows(once) == rows(_usage(later))


def test_days_outside_the_lookback_stay(spark):
    landed = raw(
        spark,
        "product_events",
        event("e1", "2024-01-01T10:00:00Z", _ingested_at="2024-01-01 11:00:00"),
        event("e2", "2024-05-01T11:00:00Z", _ingested_at="2024-05-01 12:00:00"),
    )
    staged = staging.product_events(landed)
    days = incremental.affected_days(staged, "event_timestamp", "_ingested_at", datetime(2024, 5, 1, 12))
    assert rows(days) == [(date(2024, 5, 1),)]
    assert incremental.affected_days(staged, "event_timestamp", "_ingested_at", incremental.EPOCH).count() == 2


def test_stale_days_finds_a_day_that_lost_an_event(spark):
    before = raw(spark, "product_events", event("e1", "2024-05-01T10:00:00Z"), event("e2", "2024-05-01T10:00:00Z"))
    moved = raw(
        spark,
        "product_events",
        event("e1", "2024-05-01T10:00:00Z"),
        event("e2", "2024-05-09T10:00:00Z", _ingested_at="2024-05-20 00:00:00"),
    )
    stale = incremental.stale_days(
        _usage(before), staging.product_events(moved), "event_timestamp", "event_count", datetime(2024, 5, 10)
    )
    assert rows(stale) == [(date(2024, 5, 1), False), (date(2024, 5, 9), False)]
