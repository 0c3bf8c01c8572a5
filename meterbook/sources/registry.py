"""SRC-04: the eight sources, each with its file, key, columns and rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    name: str
    format: str  # csv, jsonl or parquet
    key: str
    columns: tuple[str, ...]
    checked_time: str  # the timestamp the ingest checks
    time_required: bool = False  # events need one, entities may lack it
    version: str | None = None  # newest value wins among duplicates; without it the last row wins

    @property
    def file_name(self) -> str:
        return f"{self.name}.{self.format}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def _spec(name: str, format: str, columns: str, checked_time: str, **rules) -> SourceSpec:
    names = tuple(columns.split())
    return SourceSpec(name, format, names[0], names, checked_time, **rules)


# File formats, keys and columns of the sources, parents before children.
SOURCES: dict[str, SourceSpec] = {
    spec.name: spec
    for spec in (
        _spec(
            "organizations", "csv",
            "organization_id organization_name domain country_code organization_type created_at updated_at",
            "created_at", version="updated_at",
        ),
        _spec(
            "users", "csv",
            "user_id organization_id email country_code signup_at acquisition_channel status created_at updated_at",
            "signup_at", version="updated_at",
        ),
        _spec(
            "subscriptions", "csv",
            "subscription_id user_id organization_id plan_name billing_interval status currency amount started_at "
            "trial_started_at trial_ended_at cancelled_at current_period_start current_period_end updated_at",
            "started_at", version="updated_at",
        ),
        _spec(
            "invoices", "csv",
            "invoice_id subscription_id customer_id currency subtotal tax total status issued_at paid_at",
            "issued_at",
        ),
        _spec(
            "crm_accounts", "csv",
            "crm_account_id organization_id account_status segment owner_team lead_source created_at updated_at",
            "created_at", version="updated_at",
        ),
        _spec(
            "product_events", "jsonl",
            "event_id user_id organization_id event_name event_timestamp session_id properties",
            "event_timestamp", time_required=True,
        ),
        _spec(
            "api_usage", "parquet",
            "request_id user_id organization_id endpoint model_family request_timestamp latency_ms input_units "
            "output_units status_code estimated_cost",
            "request_timestamp", time_required=True,
        ),
        _spec(
            "marketing_events", "csv",
            "marketing_event_id user_id anonymous_id campaign_id channel event_type event_timestamp utm_source "
            "utm_medium utm_campaign",
            "event_timestamp", time_required=True,
        ),
    )
}

INGESTION_ORDER = tuple(SOURCES)
