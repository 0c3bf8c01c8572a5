"""Typed, cleaned tables with one row per key, out of the landed text.

Every function takes the landed rows and returns the staged rows. ``unique=True`` skips the
deduplication where the raw layer was loaded by the keyed upsert and already holds one row per key.
``reread=True`` reads the landed rows several times instead of sorting them all, for large stored tables
in which few keys are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook import functions as fn
from meterbook.operators.dedup import latest_per_key, settle_repeated

LINEAGE = ("_ingested_at", "_source_file", "_run_id")

# The closed vocabularies.
ORGANIZATION_TYPES = ("individual", "startup", "business", "enterprise")
USER_STATUSES = ("active", "churned", "trial")
SUBSCRIPTION_STATUSES = ("trialing", "active", "canceled", "past_due")
INVOICE_STATUSES = ("paid", "open", "failed", "void")
ACCOUNT_STATUSES = ("prospect", "active", "at_risk", "churned")
SEGMENTS = ("smb", "mid_market", "enterprise")


def _stage(
    raw: DataFrame,
    key: str,
    columns: Sequence[tuple[str, Column]],
    flags: Sequence[tuple[str, Column]],
    output: Sequence[str],
    newest_first: Sequence[str],
    unique: bool,
    reread: bool,
) -> DataFrame:
    content = [name for name, _ in columns if name not in newest_first]

    def clean(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(key), *[c.alias(name) for name, c in columns], *LINEAGE)

    def newest(rows: DataFrame) -> DataFrame:
        return latest_per_key(clean(rows), [key], newest_first, tie_break=content)

    if unique:
        cleaned = clean(raw)
    else:
        cleaned = settle_repeated(raw, key, newest, clean) if reread else newest(raw)
    # Flags follow from the cleaned columns, so they are added to the surviving rows only.
    flagged = cleaned.withColumns(dict(flags))
    return flagged.select(key, *output, *LINEAGE)


def organizations(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-01."""
    c = F.col
    return _stage(
        raw,
        "organization_id",
        [
            ("organization_name", fn.normalize_text(c("organization_name"))),
            ("domain", fn.normalize_text(c("domain"), lower=True)),
            ("country_code", fn.normalize_country_code(c("country_code"))),
            ("organization_type", fn.closed_vocabulary(c("organization_type"), ORGANIZATION_TYPES)),
            ("created_at", fn.safe_timestamp(c("created_at"))),
            ("updated_at", fn.safe_timestamp(c("updated_at"))),
        ],
        [
            ("is_country_code_recognized", fn.is_country_code_recognized(c("country_code"))),
            ("is_organization_type_unknown", c("organization_type") == "unknown"),
        ],
        ["organization_name", "domain", "country_code", "is_country_code_recognized", "organization_type",
         "is_organization_type_unknown", "created_at", "updated_at"],
        ("updated_at", "_ingested_at"),
        unique,
        reread,
    )


def users(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-02."""
    c = F.col
    return _stage(
        raw,
        "user_id",
        [
            ("organization_id", c("organization_id")),
            ("email", fn.normalize_email(c("email"))),
            ("country_code", fn.normalize_country_code(c("country_code"))),
            ("signup_at", fn.safe_timestamp(c("signup_at"))),
            ("acquisition_channel", fn.normalize_text(c("acquisition_channel"), lower=True)),
            ("status", fn.closed_vocabulary(c("status"), USER_STATUSES)),
            ("created_at", fn.safe_timestamp(c("created_at"))),
            ("updated_at", fn.safe_timestamp(c("updated_at"))),
        ],
        [
            ("is_email_valid", fn.is_email_valid(c("email"))),
            ("is_country_code_recognized", fn.is_country_code_recognized(c("country_code"))),
            ("is_status_unknown", c("status") == "unknown"),
        ],
        ["organization_id", "email", "is_email_valid", "country_code", "is_country_code_recognized",
         "signup_at", "acquisition_channel", "status", "is_status_unknown", "created_at", "updated_at"],
        ("updated_at", "_ingested_at"),
        unique,
        reread,
    )


def subscriptions(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-03."""
    c = F.col
    moments = ["started_at", "trial_started_at", "trial_ended_at", "cancelled_at", "current_period_start",
               "current_period_end", "updated_at"]
    return _stage(
        raw,
        "subscription_id",
        [
            ("user_id", c("user_id")),
            ("organization_id", c("organization_id")),
            ("plan_name", fn.blank_to_null(c("plan_name"), lower=True)),
            ("billing_interval", fn.normalize_text(c("billing_interval"), lower=True)),
            ("status", fn.closed_vocabulary(c("status"), SUBSCRIPTION_STATUSES)),
            ("currency", fn.normalize_currency(c("currency"))),
            ("subscription_amount", fn.safe_numeric(c("amount"))),
            *[(m, fn.safe_timestamp(c(m))) for m in moments],
        ],
        [
            ("is_plan_missing", c("plan_name").isNull()),
            ("is_currency_recognized", fn.is_currency_recognized(c("currency"))),
            ("is_status_unknown", c("status") == "unknown"),
        ],
        ["user_id", "organization_id", "plan_name", "is_plan_missing", "billing_interval", "status",
         "is_status_unknown", "currency", "is_currency_recognized", "subscription_amount", *moments],
        ("updated_at", "_ingested_at"),
        unique,
        reread,
    )


INVOICE_FLAGS = ("is_currency_recognized", "is_status_unknown", "is_paid_without_paid_at")


def invoice_flags() -> dict[str, Column]:
    """What follows from the cleaned columns of an invoice."""
    status = F.col("status")
    flags = (
        fn.is_currency_recognized(F.col("currency")),
        status == "unknown",
        (status == "paid") & F.col("paid_at").isNull(),
    )
    return dict(zip(INVOICE_FLAGS, flags))


def invoices(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-04."""
    c = F.col
    return _stage(
        raw,
        "invoice_id",
        [
            ("subscription_id", c("subscription_id")),
            ("customer_id", c("customer_id")),
            ("currency", fn.normalize_currency(c("currency"))),
            ("subtotal_amount", fn.safe_numeric(c("subtotal"))),
            ("tax_amount", fn.safe_numeric(c("tax"))),
            ("total_amount", fn.safe_numeric(c("total"))),
            ("status", fn.closed_vocabulary(c("status"), INVOICE_STATUSES)),
            ("issued_at", fn.safe_timestamp(c("issued_at"))),
            ("paid_at", fn.safe_timestamp(c("paid_at"))),
        ],
        list(invoice_flags().items()),
        ["subscription_id", "customer_id", "currency", "is_currency_recognized", "subtotal_amount",
         "tax_amount", "total_amount", "status", "is_status_unknown", "is_paid_without_paid_at",
         "issued_at", "paid_at"],
        ("_ingested_at",),
        unique,
        reread,
    )


def product_events(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-05: the event's own time decides its day; properties stay one JSON document."""
    c = F.col
    return _stage(
        raw,
        "event_id",
        [
            ("user_id", c("user_id")),
            ("organization_id", c("organization_id")),
            ("event_name", fn.normalize_text(c("event_name"), lower=True)),
            ("event_timestamp", fn.safe_timestamp(c("event_timestamp"))),
            ("session_id", c("session_id")),
            ("properties", c("properties")),
        ],
        [("is_event_timestamp_missing", c("event_timestamp").isNull())],
        ["user_id", "organization_id", "event_name", "event_timestamp", "is_event_timestamp_missing",
         "session_id", "properties"],
        ("_ingested_at",),
        unique,
        reread,
    )


def api_usage(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-06."""
    c = F.col
    return _stage(
        raw,
        "request_id",
        [
            ("user_id", c("user_id")),
            ("organization_id", c("organization_id")),
            ("endpoint", fn.normalize_text(c("endpoint"), lower=True)),
            ("model_family", fn.normalize_text(c("model_family"), lower=True)),
            ("request_timestamp", fn.safe_timestamp(c("request_timestamp"))),
            *[(n, fn.safe_integer(c(n))) for n in ("latency_ms", "input_units", "output_units", "status_code")],
            ("estimated_cost", fn.safe_numeric(c("estimated_cost"), 28, 9)),
        ],
        [("is_successful_request", fn.is_success_status(c("status_code")))],
        ["user_id", "organization_id", "endpoint", "model_family", "request_timestamp", "latency_ms",
         "input_units", "output_units", "status_code", "is_successful_request", "estimated_cost"],
        ("_ingested_at",),
        unique,
        reread,
    )


def crm_accounts(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-07."""
    c = F.col
    return _stage(
        raw,
        "crm_account_id",
        [
            ("organization_id", c("organization_id")),
            ("account_status", fn.closed_vocabulary(c("account_status"), ACCOUNT_STATUSES)),
            ("segment", fn.closed_vocabulary(c("segment"), SEGMENTS)),
            ("owner_team", fn.normalize_text(c("owner_team"), lower=True)),
            ("lead_source", fn.blank_to_null(c("lead_source"), lower=True)),
            ("created_at", fn.safe_timestamp(c("created_at"))),
            ("updated_at", fn.safe_timestamp(c("updated_at"))),
        ],
        [
            ("is_account_status_unknown", c("account_status") == "unknown"),
            ("is_lead_source_missing", c("lead_source").isNull()),
        ],
        ["organization_id", "account_status", "is_account_status_unknown", "segment", "owner_team",
         "lead_source", "is_lead_source_missing", "created_at", "updated_at"],
        ("updated_at", "_ingested_at"),
        unique,
        reread,
    )


def marketing_events(raw: DataFrame, unique: bool = False, reread: bool = False) -> DataFrame:
    """STG-08: an event without a user is expected, not a defect."""
    c = F.col
    return _stage(
        raw,
        "marketing_event_id",
        [
            ("user_id", c("user_id")),
            ("anonymous_id", c("anonymous_id")),
            ("campaign_id", fn.blank_to_null(c("campaign_id"))),
            ("channel", fn.normalize_text(c("channel"), lower=True)),
            ("event_type", fn.normalize_text(c("event_type"), lower=True)),
            ("event_timestamp", fn.safe_timestamp(c("event_timestamp"))),
            ("utm_source", fn.normalize_text(c("utm_source"), lower=True)),
            ("utm_medium", fn.normalize_text(c("utm_medium"), lower=True)),
            ("utm_campaign", fn.blank_to_null(c("utm_campaign"))),
        ],
        [("is_campaign_attributed", c("campaign_id").isNotNull())],
        ["user_id", "anonymous_id", "campaign_id", "is_campaign_attributed", "channel", "event_type",
         "event_timestamp", "utm_source", "utm_medium", "utm_campaign"],
        ("_ingested_at",),
        unique,
        reread,
    )
