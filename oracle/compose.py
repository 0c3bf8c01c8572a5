"""Puts the common table expressions a query needs in front of it."""

from __future__ import annotations

import re

from oracle import scenarios, tables
from oracle.results import RESULTS

TABLES = {**tables.TABLES, **scenarios.TABLES}

# Columns of any query by how they are shown: whole numbers, and decimals with their digits.
# Everything else is shown as it is.
WHOLE = set(
    """
    cohort_size period_index retained_users adopting_user_count total_event_count eligible_user_count
    active_subscription_count usage_last_30_days usage_prior_30_days usage_change_count paying_organization_count
    customers_active_at_start customers_churned request_count successful_request_count error_request_count
    total_input_units total_output_units latency_ms input_units output_units status_code event_count
    distinct_session_count product_event_count api_request_count total_activity_count transition_sequence
    days_since_previous_transition days_from_signup_to_subscription_start days_signup_to_trial days_trial_to_paid
    days_signup_to_paid days_trial_to_paid_conversion year_number quarter_number month_number week_number
    day_of_week_number observed_subscription_count new_user_signups new_organizations cumulative_user_signups
    cumulative_organizations signup_count trial_start_count paid_conversion_count failed_rows total_rows rows
    violations rows_with_file refreshed_requests rebuilt_requests product_events api_requests total_matching
    times_run times_failed times_warned total_checks passed_checks warned_checks failed_checks previous_rows
    current_rows k rows_received rows_inserted rows_updated rows_rejected raw_row_count duplicate_keys null_keys versions
    """.split()
)
DIGITS = {"estimated_ltv": 2}
SIX_DIGITS = ("_rate", "_pct", "_cost", "_hours")
FOUR_DIGITS = set(
    """
    subscription_amount subtotal_amount tax_amount total_amount billed_amount paid_amount outstanding_amount
    monthly_equivalent_amount typical_monthly_equivalent_amount mrr arr arpu current_arpu realized_ltv_to_date
    opening_recurring_revenue churned_recurring_revenue current_monthly_equivalent_revenue avg_latency_ms
    active_monthly_recurring_revenue left_total right_total
    """.split()
)


def digits_of(column: str) -> int:
    if column in DIGITS:
        return DIGITS[column]
    return 6 if column.endswith(SIX_DIGITS) else 4


def _shown(column: str, as_text: bool) -> str:
    if as_text:
        return column
    if column in WHOLE:
        return f"CAST({column} AS BIGINT) AS {column}"
    if column in FOUR_DIGITS or column in DIGITS or column.endswith(SIX_DIGITS):
        return f"ROUND(CAST({column} AS DOUBLE), {digits_of(column)}) AS {column}"
    return column


def _needed(sql: str, order: list[str]) -> None:
    for name in TABLES:
        # A name is a table where it stands behind FROM, JOIN or a comma of such a list.
        if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needed(TABLES[name], order)
            if name not in order:
                order.append(name)


# Landed rows are text, whatever their columns are called.
TEXT_RESULTS = ("ingest_landed_accounts", "ingest_landed_events", "ingest_landed_requests", "ingest_upserted_accounts")


def compose(name: str, columns: str, body: str) -> str:
    order: list[str] = []
    _needed(body, order)
    ctes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in [*order])
    head = f"WITH {ctes}\n" if ctes else ""
    return f"{head}SELECT {', '.join(_shown(c, name in TEXT_RESULTS) for c in columns.split())}\nFROM ({body}) AS answer"


def oracle_queries() -> dict[str, str]:
    return {name: compose(name, columns, body) for name, (columns, body) in RESULTS.items()}
