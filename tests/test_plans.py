"""What the physical plans must and must not contain."""

import re

import pytest

from meterbook.catalog import MODELS
from meterbook.operators import incremental
from meterbook.sources.bindings import Bindings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def w(spark, small):
    return Bindings(spark, small).warehouse()


def test_no_cross_join_and_no_python_in_any_model(w):
    for name in MODELS:
        text = plan(w.table(name))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        assert not re.search(r"Python|ArrowEval|MapInPandas", text), name


def test_recurring_revenue_joins_nothing(w):
    for name in ("mart_mrr", "mart_arr", "mart_revenue_churn"):
        assert "Join" not in plan(w.table(name)), name


def test_transitions_need_no_shuffle_of_their_own(w):
    staged, timeline = plan(w.stg_subscriptions), plan(w.int_subscription_transitions)
    assert timeline.count("Exchange") == staged.count("Exchange")


def test_scan_reads_only_the_columns_it_needs(w):
    scan = plan(w.mart_mrr)
    schema = re.findall(r"ReadSchema: (struct<[^\n]*)", scan)
    assert schema and "o_totalprice" in schema[0]


def test_a_hot_key_is_split_in_a_lookup(spark):
    """Nine of ten rows have one key; the partition that holds it is read in pieces."""
    from meterbook.operators.lookup import lookup

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 10 = 0, id, 7) as k", "uuid() as payload")
        keys = spark.range(0, 200_000, 1, 4).selectExpr("id as k", "id * 2 as v")
        joined = lookup(rows, keys, {"k": "k"}, take={"v": "v"}, matched="found")
        assert joined.filter("found and v = k * 2").count() == 200_000
        collected = joined.select("payload", "v")
        collected.write.format("noop").mode("overwrite").save()
        collected.toLocalIterator().__next__()
        assert "skew=true" in plan(collected)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_unique_landed_rows_are_staged_without_a_shuffle(spark, tmp_path, small):
    from meterbook.plans import staging

    path = str(tmp_path / "raw")
    Bindings(spark, small).product_events().write.parquet(path)
    landed = spark.read.parquet(path)
    assert "Exchange" not in plan(staging.product_events(landed, unique=True))
    # the ingest time is stored typed, so a watermark reaches the scan
    fresh = staging.product_events(landed, unique=True).filter(
        incremental.ingested_after("_ingested_at", incremental.EPOCH.replace(year=2024))
    )
    assert "GreaterThan(_ingested_at" in plan(fresh)
