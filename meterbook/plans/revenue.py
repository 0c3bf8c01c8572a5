"""Revenue marts. Money is always grouped by currency and never added across currencies."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators.lookup import lookup

CHURN_PERIOD_DAYS = 30
ALL_SEGMENTS = "all"


def _paying(fact_subscriptions: DataFrame) -> DataFrame:
    return fact_subscriptions.filter(F.col("is_recurring_active_now") & F.col("currency").isNotNull())


def _as_of(as_of: datetime) -> Column:
    return fn.date_literal(as_of).alias("as_of_date")


def mrr(fact_subscriptions: DataFrame, as_of: datetime) -> DataFrame:
    """REV-01: what active subscriptions bring per month."""
    return (
        _paying(fact_subscriptions)
        .groupBy("currency")
        .agg(F.count("*").alias("active_subscription_count"), F.sum("monthly_equivalent_amount").alias("mrr"))
        .select(_as_of(as_of), "currency", "active_subscription_count", "mrr")
    )


def arr(fact_subscriptions: DataFrame, as_of: datetime) -> DataFrame:
    """REV-02."""
    return mrr(fact_subscriptions, as_of).withColumn("arr", F.col("mrr") * 12)


def arpu(fact_subscriptions: DataFrame, as_of: datetime) -> DataFrame:
    """REV-03: per paying organization that is known; its revenue is lower than MRR by the orphans."""
    return (
        _paying(fact_subscriptions)
        .filter(F.col("organization_key").isNotNull())
        .groupBy("currency")
        .agg(
            F.sum("monthly_equivalent_amount").alias("mrr"),
            F.count_distinct("organization_key").alias("paying_organization_count"),
        )
        .select(
            _as_of(as_of),
            "currency",
            "mrr",
            "paying_organization_count",
            fn.safe_divide(F.col("mrr"), F.col("paying_organization_count")).alias("arpu"),
        )
    )


def churn_period(as_of: datetime, days: int = CHURN_PERIOD_DAYS) -> tuple[date, date]:
    """JN-12: the period is two known dates, so it needs no join."""
    end = as_of.date()
    return end - timedelta(days=days), end


def customer_churn(
    subscriptions: DataFrame, organizations: DataFrame, as_of: datetime, days: int = CHURN_PERIOD_DAYS
) -> DataFrame:
    """REV-04: organizations lost in the period, by type and over all.

    Whether an organization was active at the start and is active at the end are two booleans of
    one group, so one aggregation answers both and the anti-join (JN-16) is a filter. "Active at
    start" looks at dates only and "active at end" also at the status; an organization whose only
    subscription is past due therefore counts as churned.
    """
    start, end = churn_period(as_of, days)
    began = fn.active_at(F.col("started_at"), F.col("cancelled_at"), fn.date_literal(start).cast("timestamp"))
    stays = fn.recurring_active(F.col("status"), F.col("cancelled_at"), as_of)
    opening = (
        subscriptions.filter(F.col("organization_id").isNotNull())
        .groupBy("organization_id")
        .agg(F.bool_or(began).alias("_began"), F.bool_or(stays).alias("_stays"))
        .filter("_began")
        .select("organization_id", (~F.coalesce("_stays", F.lit(False))).alias("is_churned"))
    )
    typed = lookup(
        opening, organizations, {"organization_id": "organization_id"}, take={"_type": "organization_type"}
    )
    by_type = typed.groupBy(F.coalesce("_type", F.lit("unknown")).alias("organization_type")).agg(
        F.count("*").alias("customers_active_at_start"), F.count_if("is_churned").alias("customers_churned")
    )
    # AG-11: the total row exists even without any organization, which a rollup would not give.
    overall = by_type.agg(
        F.lit(ALL_SEGMENTS).alias("organization_type"),
        F.coalesce(F.sum("customers_active_at_start"), F.lit(0)).alias("customers_active_at_start"),
        F.coalesce(F.sum("customers_churned"), F.lit(0)).alias("customers_churned"),
    )
    return by_type.unionByName(overall).select(
        fn.date_literal(start).alias("period_start"),
        fn.date_literal(end).alias("period_end"),
        "organization_type",
        "customers_active_at_start",
        "customers_churned",
        fn.safe_divide(F.col("customers_churned"), F.col("customers_active_at_start")).alias("churn_rate"),
    )


def revenue_churn(fact_subscriptions: DataFrame, as_of: datetime, days: int = CHURN_PERIOD_DAYS) -> DataFrame:
    """REV-05: monthly revenue at the start of the period and the part of it that is gone.

    The fact has one row per subscription, so "no longer active" is a condition on that row and
    opening and churned revenue are two sums of one aggregation.
    """
    start, end = churn_period(as_of, days)
    began = fn.active_at(F.col("started_at"), F.col("cancelled_at"), fn.date_literal(start).cast("timestamp"))
    stays = fn.recurring_active(F.col("status"), F.col("cancelled_at"), as_of)
    amount = F.col("monthly_equivalent_amount")
    sums = (
        fact_subscriptions.filter(F.col("currency").isNotNull() & amount.isNotNull() & began)
        .groupBy("currency")
        .agg(
            F.sum(amount).alias("opening_recurring_revenue"),
            F.coalesce(
                F.sum(F.when(~F.coalesce(stays, F.lit(False)), amount)), F.lit(0).cast("decimal(38,15)")
            ).alias("churned_recurring_revenue"),
        )
    )
    return sums.select(
        fn.date_literal(start).alias("period_start"),
        fn.date_literal(end).alias("period_end"),
        "currency",
        "opening_recurring_revenue",
        "churned_recurring_revenue",
        fn.safe_divide(F.col("churned_recurring_revenue"), F.col("opening_recurring_revenue")).alias(
            "gross_revenue_churn_rate"
        ),
    )


def customer_ltv(fact_invoices: DataFrame, mart_arpu: DataFrame, mart_customer_churn: DataFrame) -> DataFrame:
    """REV-06: money received so far, and ARPU over churn as an estimate of the whole.

    JN-13: the platform's churn is one number, taken as a scalar subquery. No churn, no estimate.
    """
    realized = (
        fact_invoices.filter(F.col("organization_key").isNotNull() & F.col("currency").isNotNull())
        .groupBy(fn.packed_key(F.col("organization_key")).alias("_key"), "currency")
        .agg(F.sum("paid_amount").alias("realized_ltv_to_date"))
        .withColumn("organization_key", fn.unpacked_key(F.col("_key")))
    )
    churn = mart_customer_churn.filter(F.col("organization_type") == ALL_SEGMENTS).agg(F.max("churn_rate")).scalar()
    with_arpu = lookup(realized, mart_arpu, {"currency": "currency"}, take={"current_arpu": "arpu"})
    rate = F.col("platform_churn_rate")
    return with_arpu.withColumn("platform_churn_rate", churn).select(
        "organization_key",
        "currency",
        "realized_ltv_to_date",
        "current_arpu",
        "platform_churn_rate",
        F.when(rate > 0, F.col("current_arpu") / rate).alias("estimated_ltv"),
    )


def api_usage(fact_api_usage: DataFrame) -> DataFrame:
    """REV-07, AG-12, JN-21: the daily fact by month. The calendar covers every observed day, so the
    month follows from the day and the calendar join is not needed."""
    return (
        fact_api_usage.filter(F.col("organization_key").isNotNull())
        .groupBy(fn.month_start(F.col("date_day")).alias("month_start_date"), "organization_key")
        .agg(
            F.sum("request_count").alias("request_count"),
            F.sum("error_request_count").alias("error_request_count"),
            F.sum("total_estimated_cost").alias("total_estimated_cost"),
        )
        .select(
            "month_start_date",
            "organization_key",
            "request_count",
            "error_request_count",
            fn.safe_divide(F.col("error_request_count"), F.col("request_count")).alias("error_rate"),
            "total_estimated_cost",
        )
    )
