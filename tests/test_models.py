from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterbook.operators.paging import Page
from meterbook.plans import build, metrics, reads, revenue
from meterbook.plans.warehouse import Warehouse
from meterbook.quality import declared, reconcile, rules
from meterbook.sources.bindings import Bindings
from tests.helpers import AS_OF, event, org, raw, rows, sub, user


def warehouse(spark, **tables):
    names = (
        "organizations users subscriptions invoices product_events api_usage crm_accounts marketing_events".split()
    )
    return Warehouse({n: raw(spark, n, *tables.get(n, [])) for n in names}, AS_OF)


def test_churn_ignores_status_at_the_start_but_not_at_the_end(spark):
    w = warehouse(
        spark,
        organizations=[org("o1", "enterprise"), org("o2"), org("o3")],
        subscriptions=[
            sub("s1"),
            sub("s2", organization_id="o2", status="past_due"),
            sub("s3", organization_id="o3", status="canceled", cancelled_at="2024-05-20T00:00:00Z"),
            sub("s4", organization_id="o9", status="canceled", cancelled_at="2024-07-20T00:00:00Z"),
            sub("s5", organization_id="o8", started_at="2024-05-30T00:00:00Z"),
        ],
    )
    got = {r[0]: r[1:] for r in rows(w.mart_customer_churn, "organization_type", "customers_active_at_start",
                                     "customers_churned", "churn_rate")}
    assert got == {"enterprise": (1, 0, 0.0), "business": (2, 2, 1.0), "unknown": (1, 0, 0.0), "all": (4, 2, 0.5)}


def test_churn_of_nobody_is_one_row_of_zero(spark):
    w = warehouse(spark)
    assert rows(w.mart_customer_churn, "organization_type", "customers_active_at_start", "churn_rate") == [
        ("all", 0, None)
    ]


def test_revenue_marts_keep_currencies_apart(spark):
    w = warehouse(
        spark,
        organizations=[org("o1"), org("o2")],
        subscriptions=[
            sub("s1"),
            sub("s2", amount="1200.00", billing_interval="annual"),
            sub("s3", currency="eur", organization_id="o2"),
            sub("s4", organization_id="nobody"),
            sub("s5", status="past_due"),
            sub("s6", billing_interval="weekly"),
        ],
    )
    assert rows(w.mart_mrr, "currency", "active_subscription_count", "mrr") == [("EUR", 1, 100), ("USD", 4, 300)]
    assert rows(w.mart_arr, "currency", "arr") == [("EUR", 1200), ("USD", 3600)]
    # the organization that does not exist pays, but is not a known customer
    assert rows(w.mart_arpu, "currency", "mrr", "paying_organization_count", "arpu") == [
        ("EUR", 100, 1, 100.0),
        ("USD", 200, 1, 200.0),
    ]


def test_ltv_has_no_estimate_without_churn(spark):
    w = warehouse(
        spark,
        organizations=[org("o1")],
        subscriptions=[sub("s1")],
        invoices=[dict(invoice_id="i1", subscription_id="s1", currency="USD", total="50", status="paid")],
    )
    got = w.mart_customer_ltv.first()
    assert got["realized_ltv_to_date"] == 50 and got["platform_churn_rate"] == 0.0 and got["estimated_ltv"] is None
    churn = w.mart_customer_churn.withColumn("churn_rate", F.lit(0.5))
    assert revenue.customer_ltv(w.fact_invoices, w.mart_arpu, churn).first()["estimated_ltv"] == 200.0


def test_revenue_churn(spark):
    w = warehouse(
        spark,
        organizations=[org("o1")],
        subscriptions=[
            sub("s1"),
            sub("s2", status="canceled", cancelled_at="2024-05-20T00:00:00Z"),
            sub("s3", currency="GBP"),
            sub("s4", started_at="2024-05-20T00:00:00Z"),
        ],
    )
    columns = ("currency", "opening_recurring_revenue", "churned_recurring_revenue", "gross_revenue_churn_rate")
    assert rows(w.mart_revenue_churn, *columns) == [("GBP", 100, 0, 0.0), ("USD", 200, 100, 0.5)]


def test_derived_keys_are_the_keys_of_the_dimensions(spark, small):
    w = Bindings(spark, small).warehouse()
    facts = w.fact_subscriptions
    plans = w.dim_plans.select("plan_key").distinct()
    assert facts.filter("plan_key is not null").join(plans, "plan_key", "left_anti").count() == 0
    assert facts.filter("user_key is not null").join(w.dim_users, "user_key", "left_anti").count() == 0
    assert facts.filter("plan_key is null and billing_interval is not null").count() == 0


def test_funnel_and_lifecycle(spark):
    w = warehouse(
        spark,
        users=[user("u1"), user("u2")],
        subscriptions=[
            sub("s1", plan_name="free", started_at="2024-01-03T00:00:00Z"),
            sub("s2", started_at="2024-02-01T00:00:00Z", trial_started_at="2024-01-20T12:00:00Z",
                updated_at="2024-02-01T00:00:00Z", status="trialing"),
        ],
    )
    funnel = {r["user_id"]: r for r in w.int_conversion_funnel.collect()}
    assert funnel["u1"]["paid_conversion_at"] == datetime(2024, 2, 1)
    assert (funnel["u1"]["days_signup_to_trial"], funnel["u1"]["days_trial_to_paid"]) == (19, 11)
    assert funnel["u2"]["trial_start_at"] is None and funnel["u2"]["is_trial_before_signup"] is False
    assert rows(w.int_customer_lifecycle, "user_id", "lifecycle_stage") == [("u1", "trialing"), ("u2", "no_subscription")]
    trial = w.mart_trial_conversion.first()
    assert (trial["is_converted"], trial["is_observation_complete"]) == (True, True)


def test_api_requests_without_status_are_neither(spark):
    base = dict(organization_id="o1", request_timestamp="2024-05-01T00:00:00Z")
    w = warehouse(
        spark,
        api_usage=[
            dict(base, request_id="r1", status_code="200"),
            dict(base, request_id="r2", status_code="500"),
            dict(base, request_id="r3"),
            dict(base, request_id="r4", organization_id=None),
        ],
    )
    assert rows(w.int_api_usage_by_customer, "organization_id", "request_count", "successful_request_count",
                "error_request_count") == [("o1", 3, 1, 1), (None, 1, 0, 0)]


def test_build_again_changes_nothing_and_full_refresh_agrees(spark, store):
    names = "organizations users subscriptions invoices product_events api_usage crm_accounts marketing_events".split()
    tables = {
        "organizations": [org("o1")],
        "users": [user("u1")],
        "subscriptions": [sub("s1")],
        "invoices": [dict(invoice_id="i1", subscription_id="s1", currency="USD", total="100", status="open",
                          issued_at="2024-05-01T00:00:00Z")],
        "product_events": [event("e1", "2024-05-01T10:00:00Z"), event("e2", "2024-05-01T11:00:00Z")],
        "api_usage": [dict(request_id="r1", organization_id="o1", request_timestamp="2024-05-01T00:00:00Z")],
    }
    for name in names:
        store.replace(raw(spark, name, *tables.get(name, [])), "raw", name)
    w = build.build(store, build.landed_warehouse(store, AS_OF))
    assert rows(w.fact_invoices, "billed_amount", "paid_amount") == [(100, 0)]

    # the invoice is paid, one event moves to another day, one arrives late
    late = "2024-05-25 00:00:00"
    paid = raw(spark, "invoices", dict(invoice_id="i1", subscription_id="s1", currency="USD", total="100",
                                       status="paid", issued_at="2024-05-01T00:00:00Z", _ingested_at=late))
    store.replace(paid, "raw", "invoices")
    moved = raw(spark, "product_events", event("e1", "2024-05-09T10:00:00Z", _ingested_at=late),
                event("e2", "2024-05-09T11:00:00Z", _ingested_at=late),
                event("e3", "2024-05-03T11:00:00Z", _ingested_at=late))
    store.replace(moved, "raw", "product_events")
    for _ in range(2):
        w = build.build(store, build.landed_warehouse(store, AS_OF))
        assert rows(w.fact_invoices, "billed_amount", "paid_amount") == [(100, 100)]
        assert rows(w.fact_product_usage, "date_day", "event_count") == [
            (date(2024, 5, 3), 1),
            (date(2024, 5, 9), 2),
        ]
    incremental = rows(w.fact_api_usage, "date_day", "request_count", "usage_grain_key")
    full = build.build(store, build.landed_warehouse(store, AS_OF), full_refresh=True)
    assert rows(full.fact_api_usage, "date_day", "request_count", "usage_grain_key") == incremental
    history = build.read_history(store, "snap_subscriptions")
    assert history.count() == 1

    # reads and metrics over the built tables
    sources = metrics.MetricSources(full)
    assert rows(metrics.lookup_metric(sources, "mrr", currency="usd"), "mrr") == [(100,)]
    assert isinstance(metrics.lookup_metric(sources, "customer_ltv"), Page)
    detail = metrics.lookup_metric(sources, "customer_detail", organization_id="o1").first()
    assert detail["revenue_by_currency"][0]["realized_ltv_to_date"] == 100
    assert detail["usage_last_30_days"]["product_event_count"] == 3
    assert metrics.lookup_metric(sources, "customer_detail", organization_id="none").count() == 0
    assert metrics.lookup_metric(sources, "daily_growth").count() == 31


@pytest.mark.parametrize(
    "metric,filters",
    [
        ("nothing", {}),
        ("mrr", {"currency": "JPY"}),
        ("mrr", {"start": date(2024, 1, 1)}),
        ("customer_detail", {}),
        ("daily_growth", {"start": date(2024, 2, 1), "end": date(2024, 1, 1)}),
        ("daily_growth", {"start": date(2022, 1, 1), "end": date(2024, 1, 1)}),
        ("customer_ltv", {"limit": 10_000}),
        ("quality_latest", {}),
    ],
)
def test_bad_requests_are_refused(spark, metric, filters):
    with pytest.raises(ValueError):
        metrics.lookup_metric(metrics.MetricSources(warehouse(spark)), metric, **filters)


def test_there_are_fourteen_metrics():
    assert len(metrics.METRICS) == 14


def test_date_window_defaults_to_the_last_thirty_days():
    assert reads.date_window(None, None, date(2024, 1, 31)) == (date(2024, 1, 1), date(2024, 1, 31))


def test_rules_find_what_they_should(spark):
    df = spark.createDataFrame(
        [("a", -1, 0.5, "x", "p"), ("a", 1, 1.5, "y", "q"), (None, None, None, None, None), (None, 2, 0.1, "x", "p")],
        "k string, n int, r double, v string, c string",
    )
    parent = spark.createDataFrame([("p",)], "c string")
    table = {"m": df, "parent": parent}.__getitem__
    declared_rules = [
        rules.Rule("m", "not_null", ("k",)),
        rules.Rule("m", "unique", ("k",)),
        rules.Rule("m", "positive_or_zero", ("n",)),
        rules.Rule("m", "fraction", ("r",)),
        rules.Rule("m", "accepted_values", ("v",), values=("x",)),
        rules.Rule("m", "relationships", ("c",), rules.WARN, parent=("parent", "c")),
        rules.Rule("m", "unique_combination", ("k", "v")),
        rules.Rule("m", "unique", ("k",), where="n > 0"),
    ]
    counts = [r["violations"] for r in rules.count_violations(declared_rules, table).collect()]
    assert sorted(counts) == sorted([2, 1, 1, 1, 1, 1, 0, 0])
    listed = {r.kind: rules.violations(df, r, table).count() for r in declared_rules[:6]}
    assert listed == {
        "not_null": 2, "unique": 1, "positive_or_zero": 1, "fraction": 1, "accepted_values": 1, "relationships": 1,
    }


def test_reconciliation_and_declared_rules_hold_on_the_bound_data(spark, small):
    w = Bindings(spark, small).warehouse()
    assert reconcile.reconciliation(w.table).filter("not agrees").count() == 0
    errors = reconcile.row_test_counts(w.table).filter("severity = 'ERROR' and violations > 0")
    # the bindings start some trials before the signup
    assert {r["test"] for r in errors.collect()} <= {"funnel_out_of_order"}
    assert len(declared.ALL_RULES) == 200
