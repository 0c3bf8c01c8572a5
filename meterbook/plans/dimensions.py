"""Dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators.lookup import lookup
from meterbook.operators.spine import day_spine, observed_bounds
from meterbook.plans.intermediate import NO_SUBSCRIPTION


def dim_date(
    users: DataFrame,
    subscriptions: DataFrame,
    invoices: DataFrame,
    events: DataFrame,
    api_usage: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """DIM-01: every day from the first to the last observed one, ``as_of`` included."""
    bounds = observed_bounds(
        [
            (users, ["signup_at"], []),
            (subscriptions, ["started_at"], ["cancelled_at", "current_period_end"]),
            (invoices, ["issued_at"], ["issued_at"]),
            (events, ["event_timestamp"], ["event_timestamp"]),
            (api_usage, ["request_timestamp"], ["request_timestamp"]),
        ],
        as_of,
    )
    return day_spine(bounds).select("date_day", *fn.calendar_columns(F.col("date_day")))


def dim_organizations(organizations: DataFrame) -> DataFrame:
    """DIM-02."""
    return organizations.select(
        fn.surrogate_key(F.col("organization_id")).alias("organization_key"),
        "organization_id",
        "organization_name",
        "domain",
        "organization_type",
        (F.col("organization_type") == "enterprise").alias("is_enterprise"),
        "is_organization_type_unknown",
        "country_code",
        "is_country_code_recognized",
        "created_at",
        F.to_date("created_at").alias("created_date"),
    )


def plan_key(plan_name: str = "plan_name", billing_interval: str = "billing_interval"):
    """The key of a plan, as facts refer to it: NULL without an interval, which is no plan."""
    name = F.coalesce(F.col(plan_name), F.lit("unknown"))
    return F.when(F.col(billing_interval).isNotNull(), fn.surrogate_key(name, F.col(billing_interval)))


def dim_plans(subscriptions: DataFrame) -> DataFrame:
    """DIM-03, AG-08: the plans seen in use."""
    return (
        subscriptions.filter(F.col("billing_interval").isNotNull())
        .groupBy(F.coalesce("plan_name", F.lit("unknown")).alias("plan_name"), "billing_interval")
        .agg(
            F.bool_or("is_plan_missing").alias("is_plan_missing"),
            F.count("*").alias("observed_subscription_count"),
            F.avg(fn.monthly_amount(F.col("subscription_amount"), F.col("billing_interval"))).alias(
                "typical_monthly_equivalent_amount"
            ),
        )
        .select(
            plan_key().alias("plan_key"),
            "plan_name",
            "billing_interval",
            "is_plan_missing",
            "observed_subscription_count",
            "typical_monthly_equivalent_amount",
        )
    )


def dim_users(users: DataFrame, milestones: DataFrame) -> DataFrame:
    """DIM-04, JN-07, PRJ-02: no e-mail address leaves staging. The stage comes from the same
    milestones as in the lifecycle model."""
    joined = lookup(
        users, milestones, {"user_id": "user_id"}, take={"_stage": "most_recent_subscription_status"}
    )
    return joined.select(
        fn.surrogate_key(F.col("user_id")).alias("user_key"),
        "user_id",
        "organization_id",
        "country_code",
        "is_country_code_recognized",
        "signup_at",
        F.to_date("signup_at").alias("signup_date"),
        "acquisition_channel",
        F.col("status").alias("current_status"),
        F.coalesce("_stage", F.lit(NO_SUBSCRIPTION)).alias("lifecycle_stage"),
    )
