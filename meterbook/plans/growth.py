"""Growth marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators.lookup import lookup
from meterbook.operators.spine import period_grid

OBSERVATION_DAYS = 30
RETENTION_PERIODS = 24
USAGE_WINDOW_DAYS = 30


def daily_growth(dates: DataFrame, users: DataFrame, organizations: DataFrame, as_of: datetime) -> DataFrame:
    """GRW-01, JN-20, WN-07: signups and new organizations on every day, with running totals.

    Rows are counted per day first. The running total is a window without partitions, but over one
    row per calendar day, which the length of the calendar bounds.
    """
    signups = users.groupBy(F.to_date("signup_at").alias("date_day")).agg(F.count("*").alias("n"))
    created = organizations.groupBy(F.to_date("created_at").alias("date_day")).agg(F.count("*").alias("n"))
    days = dates.select("date_day").filter(F.col("date_day") <= fn.date_literal(as_of))
    counted = lookup(days, signups, {"date_day": "date_day"}, take={"_signups": "n"})
    counted = lookup(counted, created, {"date_day": "date_day"}, take={"_created": "n"})
    daily = counted.select(
        "date_day",
        F.coalesce("_signups", F.lit(0)).alias("new_user_signups"),
        F.coalesce("_created", F.lit(0)).alias("new_organizations"),
    )
    so_far = Window.orderBy("date_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "*",
        F.sum("new_user_signups").over(so_far).alias("cumulative_user_signups"),
        F.sum("new_organizations").over(so_far).alias("cumulative_organizations"),
    )


def trial_conversion(funnel: DataFrame, as_of: datetime, observation_days: int = OBSERVATION_DAYS) -> DataFrame:
    """GRW-02: users who tried, whether they paid afterwards, and whether it is too early to tell."""
    trial, paid = F.col("trial_start_at"), F.col("paid_conversion_at")
    converted = paid.isNotNull() & (paid >= trial)
    complete = fn.time_literal(as_of) - trial >= F.make_dt_interval(days=F.lit(observation_days))
    return funnel.filter(trial.isNotNull()).select(
        "user_id",
        "organization_id",
        "signup_at",
        "trial_start_at",
        "paid_conversion_at",
        converted.alias("is_converted"),
        complete.alias("is_observation_complete"),
        F.when(converted, fn.elapsed_days(trial, paid)).alias("days_trial_to_paid_conversion"),
    )


def acquisition_channels(users: DataFrame, milestones: DataFrame, revenue: DataFrame) -> DataFrame:
    """GRW-03, JN-22, JN-23: the funnel and the revenue of each channel.

    Funnel counts repeat on each currency row of a channel; a channel without revenue keeps one
    row with no currency. Invoices are summed per user before they meet the users.
    """
    channel_of = users.select("user_id", "acquisition_channel")
    steps = lookup(
        channel_of, milestones, {"user_id": "user_id"}, take={"_trial": "trial_start_at", "_paid": "paid_conversion_at"}
    )
    trial, paid = F.col("_trial"), F.col("_paid")
    funnel = steps.groupBy("acquisition_channel").agg(
        F.count("*").alias("signup_count"),
        F.count(trial).alias("trial_start_count"),
        F.count_if(paid >= trial).alias("paid_conversion_count"),
    )
    per_user = (
        revenue.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "currency")
        .agg(F.sum("billed_amount").alias("billed_amount"), F.sum("paid_amount").alias("paid_amount"))
    )
    earned = (
        per_user.join(channel_of, "user_id")
        .groupBy("acquisition_channel", "currency")
        .agg(F.sum("billed_amount").alias("_billed"), F.sum("paid_amount").alias("_paid"))
    )
    joined = lookup(
        funnel,
        earned,
        {"acquisition_channel": "acquisition_channel"},
        take={"currency": "currency", "_billed": "_billed", "_paid": "_paid"},
    )
    return joined.select(
        "acquisition_channel",
        "currency",
        "signup_count",
        "trial_start_count",
        "paid_conversion_count",
        fn.safe_divide(F.col("paid_conversion_count"), F.col("trial_start_count")).alias(
            "trial_to_paid_conversion_rate"
        ),
        F.coalesce("_billed", F.lit(0).cast("decimal(38,2)")).alias("billed_amount"),
        F.coalesce("_paid", F.lit(0).cast("decimal(38,2)")).alias("paid_amount"),
    )


def retention_cohorts(
    users: DataFrame, activity: DataFrame, as_of: datetime, periods: int = RETENTION_PERIODS
) -> DataFrame:
    """GRW-04: of each signup month's users, how many were active n months later.

    ``activity`` has ``user_id`` and ``event_date``. Only months that have begun by ``as_of`` are
    listed, with zeros where nobody came back. Activity is reduced to (user, month) before the join,
    so each row counts one user and no distinct count is needed.
    """
    cohorts = users.filter(F.col("signup_at").isNotNull()).select(
        "user_id", fn.month_start(F.to_date("signup_at")).alias("cohort_month")
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    months = (
        activity.filter(F.col("user_id").isNotNull())
        .select("user_id", fn.month_start(F.col("event_date")).alias("activity_month"))
        .distinct()
    )
    retained = (
        months.join(cohorts, "user_id")
        .filter(F.col("activity_month") >= F.col("cohort_month"))
        .groupBy(
            "cohort_month",
            fn.months_between_starts(F.col("cohort_month"), F.col("activity_month")).alias("period_index"),
        )
        .agg(F.count("*").alias("retained_users"))
    )
    grid = period_grid(sizes, "cohort_month", fn.month_start(fn.date_literal(as_of)), periods)
    joined = lookup(
        grid,
        retained,
        {"cohort_month": "cohort_month", "period_index": "period_index"},
        take={"_retained": "retained_users"},
    )
    kept = F.coalesce("_retained", F.lit(0))
    return joined.select(
        "cohort_month",
        "cohort_size",
        "period_index",
        kept.alias("retained_users"),
        fn.safe_divide(kept, F.col("cohort_size")).alias("retention_rate"),
    )


def feature_adoption(daily_usage: DataFrame, users: DataFrame) -> DataFrame:
    """GRW-05, AG-10: distinct adopters of each event, as two groupings instead of a distinct count.

    JN-13: the population is one number, taken as a scalar subquery.
    """
    per_user = (
        daily_usage.filter(F.col("user_id").isNotNull())
        .groupBy("event_name", "user_id")
        .agg(F.sum("event_count").alias("event_count"))
    )
    by_event = per_user.groupBy("event_name").agg(
        F.count("*").alias("adopting_user_count"), F.sum("event_count").alias("total_event_count")
    )
    population = users.agg(F.count("*")).scalar()
    return by_event.withColumn("eligible_user_count", population).withColumn(
        "adoption_rate", fn.safe_divide(F.col("adopting_user_count"), F.col("eligible_user_count"))
    )


def enterprise_growth(
    dim_organizations: DataFrame,
    fact_subscriptions: DataFrame,
    fact_product_usage: DataFrame,
    fact_api_usage: DataFrame,
    as_of: datetime,
    usage_as_of: datetime | None = None,
    window_days: int = USAGE_WINDOW_DAYS,
) -> DataFrame:
    """GRW-06, AG-04, AG-13, JN-24: revenue and the change of usage of each enterprise organization.

    The two usage kinds are stacked and summed once; the filter to both windows reaches the scan of
    the day-partitioned facts.
    """
    usage_as_of = usage_as_of or as_of
    revenue = (
        fact_subscriptions.filter("is_recurring_active_now")
        .groupBy("organization_key")
        .agg(F.count("*").alias("n"), F.sum("monthly_equivalent_amount").alias("amount"))
    )
    day = F.col("date_day")
    recent = fn.in_trailing_days(day, usage_as_of, window_days)
    prior = fn.in_trailing_days(day, usage_as_of, window_days, skip=window_days)
    kinds = fact_product_usage.select("organization_key", "date_day", F.col("event_count").alias("n")).unionByName(
        fact_api_usage.select("organization_key", "date_day", F.col("request_count").alias("n"))
    )
    usage = (
        kinds.filter(F.col("organization_key").isNotNull() & fn.in_trailing_days(day, usage_as_of, 2 * window_days))
        .groupBy("organization_key")
        .agg(F.sum(F.when(recent, F.col("n"))).alias("recent"), F.sum(F.when(prior, F.col("n"))).alias("prior"))
    )
    enterprises = dim_organizations.filter("is_enterprise").select("organization_key", "organization_id")
    joined = lookup(
        enterprises, revenue, {"organization_key": "organization_key"}, take={"_count": "n", "_amount": "amount"}
    )
    joined = lookup(
        joined, usage, {"organization_key": "organization_key"}, take={"_recent": "recent", "_prior": "prior"}
    )
    last, before = F.coalesce("_recent", F.lit(0)), F.coalesce("_prior", F.lit(0))
    return joined.select(
        "organization_key",
        "organization_id",
        F.coalesce("_count", F.lit(0)).alias("active_subscription_count"),
        F.col("_amount").alias("current_monthly_equivalent_revenue"),
        last.alias("usage_last_30_days"),
        before.alias("usage_prior_30_days"),
        (last - before).alias("usage_change_count"),
        fn.safe_divide(last - before, before).alias("usage_change_pct"),
    )
