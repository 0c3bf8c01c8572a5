"""Joined and aggregated models between staging and marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators.dedup import first_per_key
from meterbook.operators.lookup import lookup, orphaned
from meterbook.operators.timeline import milestone_timeline

SUBSCRIPTION_COLUMNS = (
    "plan_name", "is_plan_missing", "billing_interval", "status", "is_status_unknown", "currency",
    "is_currency_recognized", "subscription_amount", "started_at", "trial_started_at", "trial_ended_at",
    "cancelled_at", "current_period_start", "current_period_end", "updated_at",
)

NO_SUBSCRIPTION = "no_subscription"

# Milestone names; their order settles ties at one moment.
SUBSCRIPTION_MILESTONES = {
    "trial_started": "trial_started_at",
    "trial_ended": "trial_ended_at",
    "subscription_started": "started_at",
    "subscription_cancelled": "cancelled_at",
}


def user_subscription_history(subscriptions: DataFrame, users: DataFrame) -> DataFrame:
    """INT-01, JN-01: each subscription with its user's signup; unknown users are flagged."""
    joined = lookup(
        subscriptions, users, {"user_id": "user_id"}, take={"user_signup_at": "signup_at"}, matched="_has_user"
    )
    return joined.select(
        "subscription_id",
        "user_id",
        "organization_id",
        orphaned("user_id", "_has_user").alias("is_user_orphaned"),
        "user_signup_at",
        *SUBSCRIPTION_COLUMNS,
        fn.elapsed_days(F.col("user_signup_at"), F.col("started_at")).alias(
            "days_from_signup_to_subscription_start"
        ),
    )


def user_acquisition(users: DataFrame, marketing_events: DataFrame) -> DataFrame:
    """INT-02, WN-03, JN-03: first touch per user. The channel always comes from the user record."""
    first_touch = first_per_key(
        marketing_events.filter(F.col("user_id").isNotNull()),
        ["user_id"],
        [F.col("event_timestamp").asc_nulls_last(), F.col("marketing_event_id").asc()],
    )
    joined = lookup(
        users,
        first_touch,
        {"user_id": "user_id"},
        take={
            "attributed_marketing_event_id": "marketing_event_id",
            "attributed_touch_at": "event_timestamp",
            "attributed_campaign_id": "campaign_id",
            "_attributed": "is_campaign_attributed",
            "attributed_marketing_channel": "channel",
            "attributed_utm_source": "utm_source",
            "attributed_utm_medium": "utm_medium",
            "attributed_utm_campaign": "utm_campaign",
        },
        matched="has_known_marketing_touch",
    )
    return joined.select(
        "user_id",
        "organization_id",
        "acquisition_channel",
        "has_known_marketing_touch",
        "attributed_marketing_event_id",
        "attributed_touch_at",
        "attributed_campaign_id",
        F.coalesce("_attributed", F.lit(False)).alias("is_campaign_attributed"),
        "attributed_marketing_channel",
        "attributed_utm_source",
        "attributed_utm_medium",
        "attributed_utm_campaign",
    )


# What an invoice needs to know of its subscription.
OWNER_COLUMNS = ("subscription_id", "user_id", "organization_id", "plan_name", "billing_interval")


def owned_invoices(invoices: DataFrame, subscriptions: DataFrame, take: Mapping[str, str] | None = None) -> DataFrame:
    """JN-02: each invoice with its subscription's owner and plan; ``take`` names further columns to take along."""
    joined = lookup(
        invoices,
        subscriptions,
        {"subscription_id": "subscription_id"},
        take={
            "user_id": "user_id",
            "_organization_id": "organization_id",
            "plan_name": "plan_name",
            "billing_interval": "billing_interval",
            **(take or {}),
        },
        matched="_has_subscription",
    )
    return joined.withColumn("is_subscription_orphaned", orphaned("subscription_id", "_has_subscription"))


def invoice_amounts(invoices: DataFrame) -> DataFrame:
    """FN-26: the amounts by status."""
    status, total = F.col("status"), F.col("total_amount")
    return invoices.withColumns(
        {
            "billed_amount": total,
            "paid_amount": fn.paid_amount(status, total),
            "outstanding_amount": fn.outstanding_amount(status, total),
        }
    )


def customer_revenue(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """INT-03, JN-02: one row per invoice with its subscription's owner and the amounts by status."""
    return invoice_amounts(owned_invoices(invoices, subscriptions)).select(
        "invoice_id",
        "subscription_id",
        "is_subscription_orphaned",
        F.coalesce("_organization_id", "customer_id").alias("customer_id"),
        "user_id",
        "plan_name",
        "billing_interval",
        "currency",
        "is_currency_recognized",
        "subtotal_amount",
        "tax_amount",
        "total_amount",
        "status",
        "is_status_unknown",
        "is_paid_without_paid_at",
        "billed_amount",
        "paid_amount",
        "outstanding_amount",
        "issued_at",
        "paid_at",
        "_ingested_at",
    )


def daily_product_usage(events: DataFrame, day: str = "event_date", with_ingest_time: bool = False) -> DataFrame:
    """INT-04: events per (day, user, organization, event) by event time, however late they came."""
    extra = [F.max("_ingested_at").alias("_last_ingested_at")] if with_ingest_time else []
    return (
        events.filter(F.col("event_timestamp").isNotNull())
        .groupBy(F.to_date("event_timestamp").alias(day), "user_id", "organization_id", "event_name")
        .agg(
            F.count("*").alias("event_count"),
            F.count_distinct("session_id").alias("distinct_session_count"),
            F.min("event_timestamp").alias("first_event_at"),
            F.max("event_timestamp").alias("last_event_at"),
            *extra,
        )
    )


def api_usage_by_customer(usage: DataFrame, day: str = "usage_date", with_ingest_time: bool = False) -> DataFrame:
    """INT-05, AG-02, AG-14: requests per (day, organization); no organization is a group of its own.

    A request without a status is neither success nor error, so the two need not add up.
    """
    extra = [F.max("_ingested_at").alias("_last_ingested_at")] if with_ingest_time else []
    daily = (
        usage.filter(F.col("request_timestamp").isNotNull())
        .groupBy(F.to_date("request_timestamp").alias(day), "organization_id")
        .agg(
            F.count("*").alias("request_count"),
            F.count_if(F.col("is_successful_request")).alias("successful_request_count"),
            F.count_if(~F.col("is_successful_request")).alias("error_request_count"),
            F.sum("input_units").alias("total_input_units"),
            F.sum("output_units").alias("total_output_units"),
            F.sum("estimated_cost").alias("total_estimated_cost"),
            F.avg("latency_ms").alias("avg_latency_ms"),
            *extra,
        )
    )
    return daily.select(
        day,
        "organization_id",
        F.col("organization_id").isNull().alias("is_organization_unknown"),
        "request_count",
        "successful_request_count",
        "error_request_count",
        fn.safe_divide(F.col("error_request_count"), F.col("request_count")).alias("error_rate"),
        "total_input_units",
        "total_output_units",
        "total_estimated_cost",
        "avg_latency_ms",
        *(["_last_ingested_at"] if with_ingest_time else []),
    )


def subscription_transitions(subscriptions: DataFrame) -> DataFrame:
    """INT-06: the observed milestones of each subscription in order."""
    timeline = milestone_timeline(
        subscriptions, ["subscription_id", "user_id", "organization_id"], SUBSCRIPTION_MILESTONES
    )
    return timeline.select(
        "subscription_id",
        "user_id",
        "organization_id",
        "transition_sequence",
        "transition_type",
        "transition_at",
        "previous_transition_type",
        "previous_transition_at",
        "days_since_previous_transition",
    )


def customer_activity(daily_product: DataFrame, daily_api: DataFrame) -> DataFrame:
    """INT-07, JN-06: product and API activity per (day, organization), days without any left out.

    Both sides are stacked and summed instead of joined in full: a pair appears once if either side
    has it, neither side can multiply the other, and there is one shuffle where a join has two.
    The window runs over an organization's active days, a group the calendar bounds.
    """
    product = daily_product.select(
        F.col("event_date").alias("activity_date"),
        "organization_id",
        F.col("event_count").alias("product"),
        F.lit(None).cast("bigint").alias("api"),
    )
    api = daily_api.select(
        F.col("usage_date").alias("activity_date"),
        "organization_id",
        F.lit(None).cast("bigint").alias("product"),
        F.col("request_count").alias("api"),
    )
    combined = (
        product.unionByName(api)
        .filter(F.col("organization_id").isNotNull())
        .groupBy("activity_date", "organization_id")
        .agg(F.sum("product").alias("product"), F.sum("api").alias("api"))
    )
    organization = Window.partitionBy("organization_id")
    products, requests = F.coalesce("product", F.lit(0)), F.coalesce("api", F.lit(0))
    return combined.select(
        "activity_date",
        "organization_id",
        F.col("product").isNotNull().alias("has_product_activity"),
        F.col("api").isNotNull().alias("has_api_activity"),
        products.alias("product_event_count"),
        requests.alias("api_request_count"),
        (products + requests).alias("total_activity_count"),
        F.min("activity_date").over(organization).alias("first_observed_activity_date"),
        F.max("activity_date").over(organization).alias("last_observed_activity_date"),
    )


def subscription_milestones(subscriptions: DataFrame) -> DataFrame:
    """Everything the user-level models need from a user's subscriptions, in one aggregation.

    WN-02 (the most recent subscription) is a maximum here, so it combines before the shuffle like
    the minima beside it and a user with a third of all subscriptions is no hot task.
    """
    recency = F.struct("updated_at", "subscription_id")
    return (
        subscriptions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min("trial_started_at").alias("trial_start_at"),
            F.min(F.when(fn.is_paid_plan(F.col("plan_name")), F.col("started_at"))).alias("paid_conversion_at"),
            F.min("cancelled_at").alias("first_cancelled_at"),
            F.max_by(F.struct("status", "plan_name"), recency).alias("_latest"),
        )
        .select(
            "user_id",
            "trial_start_at",
            "paid_conversion_at",
            "first_cancelled_at",
            F.col("_latest.status").alias("most_recent_subscription_status"),
            F.col("_latest.plan_name").alias("most_recent_plan_name"),
        )
    )


def conversion_funnel(users: DataFrame, milestones: DataFrame) -> DataFrame:
    """INT-08, AG-03, JN-04: when each user signed up, first tried and first paid."""
    joined = lookup(
        users,
        milestones,
        {"user_id": "user_id"},
        take={"trial_start_at": "trial_start_at", "paid_conversion_at": "paid_conversion_at"},
    )
    signup, trial, paid = F.col("signup_at"), F.col("trial_start_at"), F.col("paid_conversion_at")

    def happened_before(later, earlier):
        # An absent milestone is false; an absent signup leaves the question open (NULL).
        return later.isNotNull() & (later < earlier)

    return joined.select(
        "user_id",
        "organization_id",
        "signup_at",
        "trial_start_at",
        "paid_conversion_at",
        happened_before(trial, signup).alias("is_trial_before_signup"),
        happened_before(paid, signup).alias("is_paid_conversion_before_signup"),
        (trial.isNotNull() & paid.isNotNull() & (paid < trial)).alias("is_paid_conversion_before_trial_start"),
        fn.elapsed_days(signup, trial).alias("days_signup_to_trial"),
        fn.elapsed_days(trial, paid).alias("days_trial_to_paid"),
        fn.elapsed_days(signup, paid).alias("days_signup_to_paid"),
    )


def customer_lifecycle(users: DataFrame, milestones: DataFrame) -> DataFrame:
    """INT-09, JN-05: milestones and today's stage per user."""
    joined = lookup(
        users,
        milestones,
        {"user_id": "user_id"},
        take={
            "first_trial_started_at": "trial_start_at",
            "first_paid_started_at": "paid_conversion_at",
            "first_cancelled_at": "first_cancelled_at",
            "most_recent_subscription_status": "most_recent_subscription_status",
            "most_recent_plan_name": "most_recent_plan_name",
        },
    )
    return joined.select(
        "user_id",
        "organization_id",
        F.col("signup_at").alias("first_signup_at"),
        "first_trial_started_at",
        "first_paid_started_at",
        "first_cancelled_at",
        "most_recent_subscription_status",
        "most_recent_plan_name",
        F.coalesce("most_recent_subscription_status", F.lit(NO_SUBSCRIPTION)).alias("lifecycle_stage"),
    )
