"""The rules declared on each model."""

from __future__ import annotations

from meterbook.plans import staging
from meterbook.quality.rules import ERROR, WARN, Rule
from meterbook.sources.registry import SOURCES

_UNKNOWN = ("unknown",)


def _rules(model: str, *, not_null="", unique="", amounts="", fractions="", combos=(), extra=()) -> list[Rule]:
    rules = [Rule(model, "not_null", (c,)) for c in not_null.split()]
    rules += [Rule(model, "unique", (c,)) for c in unique.split()]
    rules += [Rule(model, "positive_or_zero", (c,)) for c in amounts.split()]
    rules += [Rule(model, "fraction", (c,)) for c in fractions.split()]
    rules += [Rule(model, "unique_combination", tuple(c.split())) for c in combos]
    rules += [Rule(model, kind, tuple(columns.split()), **options) for kind, columns, options in extra]
    return rules


def _values(column: str, allowed: tuple[str, ...]) -> tuple:
    return "accepted_values", column, {"values": allowed}


def _parent(column: str, model: str, key: str | None = None, severity: str = WARN) -> tuple:
    return "relationships", column, {"parent": (model, key or column), "severity": severity}


def _order(start: str, end: str) -> tuple:
    return "valid_timestamp_order", f"{start} {end}", {}


_TO_USER = _parent("user_id", "stg_users")
_TO_ORGANIZATION = _parent("organization_id", "stg_organizations")
_CURRENCY = ("valid_currency_code", "currency", {})
_STAGES = (*staging.SUBSCRIPTION_STATUSES, "unknown", "no_subscription")

# The landed tables, named raw_<source>: a key that is there and occurs once.
SOURCE_RULES = [
    rule for spec in SOURCES.values() for rule in _rules(f"raw_{spec.name}", not_null=spec.key, unique=spec.key)
]

STAGING_RULES = [
    *_rules("stg_organizations", not_null="organization_id", unique="organization_id",
            extra=[_values("organization_type", staging.ORGANIZATION_TYPES + _UNKNOWN)]),
    *_rules("stg_users", not_null="user_id is_email_valid", unique="user_id",
            extra=[_TO_ORGANIZATION, _values("status", staging.USER_STATUSES + _UNKNOWN)]),
    *_rules("stg_subscriptions", not_null="subscription_id", unique="subscription_id", amounts="subscription_amount",
            extra=[_TO_USER, _TO_ORGANIZATION, _CURRENCY,
                   _values("status", staging.SUBSCRIPTION_STATUSES + _UNKNOWN),
                   _order("trial_started_at", "trial_ended_at"), _order("started_at", "cancelled_at")]),
    *_rules("stg_invoices", not_null="invoice_id", unique="invoice_id",
            amounts="subtotal_amount tax_amount total_amount",
            extra=[_parent("subscription_id", "stg_subscriptions"), _CURRENCY,
                   _values("status", staging.INVOICE_STATUSES + _UNKNOWN)]),
    *_rules("stg_product_events", not_null="event_id", unique="event_id", extra=[_TO_USER]),
    *_rules("stg_api_usage", not_null="request_id", unique="request_id",
            amounts="latency_ms input_units output_units estimated_cost", extra=[_TO_USER, _TO_ORGANIZATION]),
    *_rules("stg_crm_accounts", not_null="crm_account_id", unique="crm_account_id",
            extra=[_TO_ORGANIZATION, _values("account_status", staging.ACCOUNT_STATUSES + _UNKNOWN),
                   _values("segment", staging.SEGMENTS + _UNKNOWN)]),
    *_rules("stg_marketing_events", not_null="marketing_event_id", unique="marketing_event_id",
            extra=[_TO_USER, _values("event_type", ("impression", "click", "signup_start", "signup_complete"))]),
]

INTERMEDIATE_RULES = [
    *_rules("int_user_subscription_history", not_null="subscription_id", unique="subscription_id",
            amounts="subscription_amount"),
    *_rules("int_user_acquisition", not_null="user_id", unique="user_id"),
    *_rules("int_customer_revenue", not_null="invoice_id", unique="invoice_id",
            amounts="billed_amount paid_amount outstanding_amount"),
    *_rules("int_daily_product_usage", not_null="event_date", amounts="event_count distinct_session_count",
            combos=["event_date user_id organization_id event_name"]),
    *_rules("int_api_usage_by_customer", not_null="usage_date",
            amounts="request_count error_request_count total_estimated_cost", combos=["usage_date organization_id"]),
    *_rules("int_subscription_transitions", not_null="subscription_id transition_at",
            combos=["subscription_id transition_type"],
            extra=[_values("transition_type", ("trial_started", "trial_ended", "subscription_started",
                                               "subscription_cancelled"))]),
    *_rules("int_customer_activity", not_null="activity_date organization_id",
            amounts="product_event_count api_request_count", combos=["activity_date organization_id"]),
    *_rules("int_conversion_funnel", not_null="user_id", unique="user_id"),
    *_rules("int_customer_lifecycle", not_null="user_id", unique="user_id",
            extra=[_values("lifecycle_stage", _STAGES)]),
]

MART_RULES = [
    *_rules("dim_users", not_null="user_key user_id", unique="user_key user_id"),
    *_rules("dim_organizations", not_null="organization_key organization_id",
            unique="organization_key organization_id",
            extra=[_values("organization_type", staging.ORGANIZATION_TYPES + _UNKNOWN)]),
    *_rules("dim_plans", not_null="plan_key", unique="plan_key",
            extra=[_values("billing_interval", ("monthly", "annual"))]),
    *_rules("dim_date", not_null="date_day", unique="date_day"),
    *_rules("fact_subscriptions", not_null="subscription_id", unique="subscription_id",
            amounts="subscription_amount monthly_equivalent_amount", combos=["subscription_id"],
            extra=[_parent("user_key", "dim_users"), _parent("organization_key", "dim_organizations")]),
    *_rules("fact_invoices", not_null="invoice_id _last_ingested_at", unique="invoice_id",
            amounts="billed_amount paid_amount outstanding_amount", combos=["invoice_id"],
            extra=[_parent("organization_key", "dim_organizations")]),
    *_rules("fact_product_usage", not_null="usage_grain_key date_day _last_ingested_at", unique="usage_grain_key",
            amounts="event_count",
            combos=["usage_grain_key", "date_day user_key organization_key event_name"]),
    *_rules("fact_api_usage", not_null="usage_grain_key date_day _last_ingested_at", unique="usage_grain_key",
            amounts="request_count", fractions="error_rate",
            combos=["usage_grain_key", "date_day organization_key"]),
    *_rules("mart_daily_growth", not_null="date_day", amounts="new_user_signups new_organizations",
            combos=["date_day"]),
    *_rules("mart_trial_conversion", not_null="user_id trial_start_at", unique="user_id"),
    *_rules("mart_acquisition_channels", not_null="acquisition_channel", amounts="billed_amount paid_amount",
            fractions="trial_to_paid_conversion_rate"),
    *_rules("mart_retention_cohorts", not_null="cohort_month period_index", amounts="cohort_size retained_users",
            fractions="retention_rate", combos=["cohort_month period_index"]),
    *_rules("mart_feature_adoption", not_null="event_name", unique="event_name", amounts="adopting_user_count",
            fractions="adoption_rate"),
    *_rules("mart_enterprise_growth", not_null="organization_key", unique="organization_key",
            amounts="current_monthly_equivalent_revenue",
            extra=[_parent("organization_key", "dim_organizations", severity=ERROR)]),
    *_rules("mart_mrr", not_null="currency", amounts="mrr", combos=["as_of_date currency"]),
    *_rules("mart_arr", not_null="currency", amounts="arr", combos=["as_of_date currency"]),
    *_rules("mart_customer_churn", not_null="period_start period_end",
            amounts="customers_active_at_start customers_churned", fractions="churn_rate",
            combos=["period_start period_end organization_type"]),
    *_rules("mart_revenue_churn", not_null="currency",
            amounts="opening_recurring_revenue churned_recurring_revenue", fractions="gross_revenue_churn_rate",
            combos=["period_start period_end currency"]),
    *_rules("mart_customer_ltv", not_null="organization_key", amounts="realized_ltv_to_date",
            combos=["organization_key currency"],
            extra=[_parent("organization_key", "dim_organizations", severity=ERROR)]),
    *_rules("mart_arpu", not_null="currency", amounts="paying_organization_count arpu",
            combos=["as_of_date currency"]),
    *_rules("mart_api_usage", not_null="month_start_date", amounts="request_count", fractions="error_rate",
            combos=["month_start_date organization_key"]),
]

SNAPSHOT_RULES = [
    *_rules("snap_subscriptions", not_null="subscription_id valid_from",
            extra=[("unique", "subscription_id", {"where": "valid_to IS NULL"}), _order("valid_from", "valid_to")]),
    *_rules("snap_crm_accounts", not_null="crm_account_id valid_from",
            extra=[("unique", "crm_account_id", {"where": "valid_to IS NULL"}), _order("valid_from", "valid_to")]),
]

ALL_RULES = [*SOURCE_RULES, *STAGING_RULES, *INTERMEDIATE_RULES, *MART_RULES, *SNAPSHOT_RULES]
