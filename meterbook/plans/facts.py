"""Facts.

A fact refers to a dimension row by the hash of its business key. Once a lookup has shown that the
row exists, the hash follows from the key at hand, so lookups read key columns only. Plans need no
lookup at all: a plan row exists for every plan and interval the subscriptions use.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators.lookup import known, lookup, orphaned
from meterbook.plans import staging
from meterbook.plans.dimensions import plan_key
from meterbook.plans.intermediate import (
    OWNER_COLUMNS,
    api_usage_by_customer,
    daily_product_usage,
    invoice_amounts,
    owned_invoices,
)


def _found_key(key: str, matched: str) -> Column:
    return F.when(F.col(matched), fn.surrogate_key(F.col(key)))


def subscription_terms(subscriptions: DataFrame, as_of: datetime) -> DataFrame:
    """FN-11, FN-12: what each subscription pays, and whether it does now. Nothing is looked up, so
    a mart that needs only this never joins."""
    return subscriptions.withColumns(
        {
            "is_recurring_active_now": fn.recurring_active(F.col("status"), F.col("cancelled_at"), as_of),
            "monthly_equivalent_amount": fn.monthly_amount(F.col("subscription_amount"), F.col("billing_interval")),
        }
    )


def with_organization_key(rows: DataFrame, organizations: DataFrame, key: str = "organization_id") -> DataFrame:
    """JN-08..11: the key of an organization that exists, and a flag for one that does not."""
    return _with_matched_key(matched_organization(rows, organizations, key), key)


def fact_subscriptions(history: DataFrame, organizations: DataFrame, as_of: datetime) -> DataFrame:
    """FCT-01, JN-08: one row per subscription; whether its user exists is known from ``history``."""
    return keyed_subscriptions(matched_organization(history, organizations), as_of)


def stored_subscriptions(subscriptions: DataFrame, users: DataFrame, organizations: DataFrame, as_of: datetime) -> DataFrame:
    """FCT-01 from stored subscriptions, which stay where they are: the fact only needs to know which users and
    organizations exist."""
    checks = {
        "_has_user": ("user_id", users, "user_id"),
        "_has_organization": ("organization_id", organizations, "organization_id"),
    }
    rows = known(subscriptions, checks).withColumn("is_user_orphaned", orphaned("user_id", "_has_user"))
    return keyed_subscriptions(rows, as_of)


def keyed_subscriptions(rows: DataFrame, as_of: datetime) -> DataFrame:
    known_user = F.col("user_id").isNotNull() & ~F.col("is_user_orphaned")
    return _with_matched_key(subscription_terms(rows, as_of)).select(
        "subscription_id",
        F.when(known_user, fn.surrogate_key(F.col("user_id"))).alias("user_key"),
        "is_user_orphaned",
        "organization_key",
        "is_organization_unmatched",
        plan_key().alias("plan_key"),
        "plan_name",
        "is_plan_missing",
        "billing_interval",
        "status",
        "is_status_unknown",
        "is_recurring_active_now",
        "currency",
        "is_currency_recognized",
        "subscription_amount",
        "monthly_equivalent_amount",
        "started_at",
        "trial_started_at",
        "trial_ended_at",
        "cancelled_at",
        "current_period_start",
        "current_period_end",
        "updated_at",
    )


def matched_organization(rows: DataFrame, organizations: DataFrame, key: str = "organization_id") -> DataFrame:
    return lookup(rows, organizations, {key: "organization_id"}, matched="_has_organization")


def _with_matched_key(rows: DataFrame, key: str = "organization_id") -> DataFrame:
    return rows.withColumns(
        {
            "organization_key": _found_key(key, "_has_organization"),
            "is_organization_unmatched": orphaned(key, "_has_organization"),
        }
    ).drop("_has_organization")


def fact_invoices(revenue: DataFrame, organizations: DataFrame) -> DataFrame:
    """FCT-02, JN-09: one row per invoice, with its ingest time as the next watermark."""
    return keyed_invoices(matched_organization(revenue, organizations, "customer_id"))


def matched_invoices(invoices: DataFrame, subscriptions: DataFrame, organizations: DataFrame) -> DataFrame:
    """Invoices that have met their dimensions, without what ``finished_invoices`` derives from them.

    They move once, to their subscription: whether an organization exists is found out beside the
    subscriptions, and beside the invoices for customers of invoices without one. Both are read several times,
    so they should be stored.
    """
    owners = known(
        subscriptions.select(*OWNER_COLUMNS),
        {"_known": ("organization_id", organizations, "organization_id")},
    )
    # Texts beside texts and numbers beside numbers compress better in rows that move.
    kept = sorted(invoices.drop("_source_file", "_run_id", *staging.INVOICE_FLAGS).dtypes, key=lambda c: c[1] != "string")
    narrow = invoices.select(*[name for name, _ in kept])
    rows = known(narrow, {"_has_customer": ("customer_id", organizations, "organization_id")})
    owned = owned_invoices(rows, owners, take={"_known": "_known"})
    own, has_own = F.col("_organization_id"), F.col("_organization_id").isNotNull()
    return owned.withColumns(
        {
            "_has_organization": F.when(has_own, F.col("_known")).otherwise(F.col("_has_customer")),
            "customer_id": F.coalesce(own, "customer_id"),
        }
    ).drop("_organization_id", "_known", "_has_customer", "_has_subscription")


def finished_invoices(rows: DataFrame) -> DataFrame:
    return keyed_invoices(invoice_amounts(rows.withColumns(staging.invoice_flags())))


# What a fact adds to rows that have met their dimensions. Hashed keys are long and do not compress, so
# a stored fact gets them after its rows have moved to their partitions.
def keyed_invoices(rows: DataFrame) -> DataFrame:
    return _with_matched_key(rows, "customer_id").select(
        "invoice_id",
        "subscription_id",
        "is_subscription_orphaned",
        "organization_key",
        "is_organization_unmatched",
        plan_key().alias("plan_key"),
        "user_id",
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
        F.col("_ingested_at").alias("_last_ingested_at"),
    )


def fact_product_usage(events: DataFrame, users: DataFrame, organizations: DataFrame) -> DataFrame:
    """FCT-03, JN-10: daily usage. Events are aggregated before the lookups, so they join as groups."""
    return keyed_product_usage(matched_product_usage(events, users, organizations))


def matched_product_usage(events: DataFrame, users: DataFrame, organizations: DataFrame) -> DataFrame:
    daily = daily_product_usage(events, day="date_day", with_ingest_time=True)
    return matched_organization(lookup(daily, users, {"user_id": "user_id"}, matched="_has_user"), organizations)


def keyed_product_usage(rows: DataFrame) -> DataFrame:
    return _with_matched_key(rows).select(
        # INC-04: blank stands for a missing key, since NULL never equals NULL when rows are replaced.
        fn.surrogate_key(
            F.col("date_day"),
            F.coalesce("user_id", F.lit("")),
            F.coalesce("organization_id", F.lit("")),
            F.col("event_name"),
        ).alias("usage_grain_key"),
        "date_day",
        "user_id",
        _found_key("user_id", "_has_user").alias("user_key"),
        orphaned("user_id", "_has_user").alias("is_user_unmatched"),
        "organization_id",
        "organization_key",
        "is_organization_unmatched",
        "event_name",
        "event_count",
        "distinct_session_count",
        "first_event_at",
        "last_event_at",
        "_last_ingested_at",
    )


def fact_api_usage(usage: DataFrame, organizations: DataFrame) -> DataFrame:
    """FCT-04, JN-11: daily API usage per organization."""
    return keyed_api_usage(matched_api_usage(usage, organizations))


def matched_api_usage(usage: DataFrame, organizations: DataFrame) -> DataFrame:
    return matched_organization(api_usage_by_customer(usage, day="date_day", with_ingest_time=True), organizations)


def keyed_api_usage(rows: DataFrame) -> DataFrame:
    return _with_matched_key(rows).select(
        fn.surrogate_key(F.col("date_day"), F.coalesce("organization_id", F.lit(""))).alias("usage_grain_key"),
        "date_day",
        "organization_id",
        "organization_key",
        "is_organization_unknown",
        "is_organization_unmatched",
        "request_count",
        "successful_request_count",
        "error_request_count",
        "error_rate",
        "total_input_units",
        "total_output_units",
        "total_estimated_cost",
        "avg_latency_ms",
        "_last_ingested_at",
    )
