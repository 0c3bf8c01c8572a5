"""DQ-10..13: rules across models. Each returns the rows that break it; none is the good outcome."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.functions import month_start
from meterbook.operators.lookup import lookup
from meterbook.quality.rules import ERROR, WARN

Tables = Callable[[str], DataFrame]
SIDES = ("left_total", "right_total")


@dataclass(frozen=True)
class Total:
    model: str
    value: Column

    @property
    def shown(self) -> Column:
        return F.coalesce(self.value, F.lit(0)).cast("decimal(38,2)")


def _rows(model: str, where: Column | None = None) -> Total:
    return Total(model, F.count("*") if where is None else F.count_if(where))


def _sum(model: str, column: str) -> Total:
    return Total(model, F.sum(column))


def _totals() -> dict[str, tuple[Total, Total]]:
    """DQ-10 and DQ-11: both sides must give the same total."""
    return {
        "fact_invoices_rows": (_rows("fact_invoices"), _rows("int_customer_revenue")),
        "fact_subscriptions_rows": (_rows("fact_subscriptions"), _rows("int_user_subscription_history")),
        "int_customer_revenue_rows": (_rows("int_customer_revenue"), _rows("stg_invoices")),
        "int_user_subscription_history_rows": (_rows("int_user_subscription_history"), _rows("stg_subscriptions")),
        "fact_api_usage_requests": (
            _sum("fact_api_usage", "request_count"),
            _sum("int_api_usage_by_customer", "request_count"),
        ),
        "fact_product_usage_events": (
            _sum("fact_product_usage", "event_count"),
            _sum("int_daily_product_usage", "event_count"),
        ),
        "int_customer_revenue_billed": (
            _sum("int_customer_revenue", "billed_amount"),
            _sum("stg_invoices", "total_amount"),
        ),
        "int_daily_product_usage_events": (
            _sum("int_daily_product_usage", "event_count"),
            _rows("stg_product_events", ~F.col("is_event_timestamp_missing")),
        ),
        "int_api_usage_by_customer_requests": (
            _sum("int_api_usage_by_customer", "request_count"),
            _rows("stg_api_usage", F.col("request_timestamp").isNotNull()),
        ),
    }


def reconciliation(table: Tables) -> DataFrame:
    """DQ-10, DQ-11: one row per pair of totals: ``test, left_total, right_total, agrees``.

    All totals of a model come from one pass over it, however many pairs it is part of.
    """
    wanted = [(name, side, total) for name, sides in _totals().items() for side, total in zip(SIDES, sides)]
    parts = []
    for model in dict.fromkeys(total.model for _, _, total in wanted):
        own = [(name, side, total.shown) for name, side, total in wanted if total.model == model]
        counted = table(model).agg(*[shown.alias(f"t{i}") for i, (_, _, shown) in enumerate(own)])
        listed = [
            F.struct(F.lit(name).alias("test"), F.lit(side).alias("side"), F.col(f"t{i}").alias("total"))
            for i, (name, side, _) in enumerate(own)
        ]
        parts.append(counted.select(F.inline(F.array(*listed))))
    pairs = reduce(DataFrame.unionByName, parts).groupBy("test").agg(
        *[F.max(F.when(F.col("side") == side, F.col("total"))).alias(side) for side in SIDES]
    )
    return pairs.withColumn("agrees", F.col("left_total") == F.col("right_total"))


def invoice_paid_before_issued(table: Tables) -> DataFrame:
    """DQ-12 (a warning)."""
    return table("stg_invoices").filter(F.col("paid_at") < F.col("issued_at"))


def cancelled_before_started(table: Tables) -> DataFrame:
    """DQ-12."""
    return table("stg_subscriptions").filter(F.col("cancelled_at") < F.col("started_at"))


def transitions_out_of_order(table: Tables) -> DataFrame:
    """DQ-12."""
    return table("int_subscription_transitions").filter(F.col("transition_at") < F.col("previous_transition_at"))


def funnel_out_of_order(table: Tables) -> DataFrame:
    """DQ-12."""
    return table("int_conversion_funnel").filter("is_trial_before_signup OR is_paid_conversion_before_signup")


def _differs(a: Column, b: Column) -> Column:
    return F.round(a, 2) != F.round(b, 2)


def monthly_amount_mismatch(table: Tables) -> DataFrame:
    """DQ-13: the stored monthly amount against the amount it comes from."""
    facts = table("fact_subscriptions")
    amount, monthly, interval = (
        F.col("subscription_amount").cast("decimal(28,12)"),
        F.col("monthly_equivalent_amount"),
        F.col("billing_interval"),
    )
    wrong = ((interval == "monthly") & _differs(monthly, amount)) | (
        (interval == "annual") & _differs(monthly, amount / F.lit(12))
    )
    return facts.filter(amount.isNotNull() & wrong)


def arr_mismatch(table: Tables) -> DataFrame:
    """DQ-13, JN-28: ARR must be twelve times MRR in every currency."""
    both = lookup(table("mart_mrr"), table("mart_arr"), {"currency": "currency"}, take={"arr": "arr"})
    return both.filter(_differs(F.col("mrr") * 12, F.col("arr"))).select("currency", "mrr", "arr")


def cohort_size_mismatch(table: Tables) -> DataFrame:
    """DQ-13, JN-28: cohort sizes against the users that signed up in the month."""
    actual = (
        table("dim_users")
        .filter(F.col("signup_date").isNotNull())
        .groupBy(month_start(F.col("signup_date")).alias("cohort_month"))
        .agg(F.count("*").alias("actual_cohort_size"))
    )
    listed = table("mart_retention_cohorts").select("cohort_month", "cohort_size").distinct()
    return actual.join(listed, "cohort_month").filter(F.col("actual_cohort_size") != F.col("cohort_size"))


# DQ-12 and DQ-13: rows that must not exist, and how serious they are.
ROW_TESTS: dict[str, tuple[str, Callable[[Tables], DataFrame]]] = {
    "invoice_paid_before_issued": (WARN, invoice_paid_before_issued),
    "cancelled_before_started": (ERROR, cancelled_before_started),
    "transitions_out_of_order": (ERROR, transitions_out_of_order),
    "funnel_out_of_order": (ERROR, funnel_out_of_order),
    "monthly_amount_mismatch": (ERROR, monthly_amount_mismatch),
    "arr_mismatch": (ERROR, arr_mismatch),
    "cohort_size_mismatch": (ERROR, cohort_size_mismatch),
}


def row_test_counts(table: Tables) -> DataFrame:
    """DQ-12, DQ-13: ``test, severity, violations``."""
    parts = [
        find(table).agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("test"), F.lit(severity).alias("severity"), "violations"
        )
        for name, (severity, find) in ROW_TESTS.items()
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined
