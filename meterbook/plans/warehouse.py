"""All models of one set of landed tables, wired together.

Every attribute is a lazy DataFrame: reading one model builds the plan of just that model, and
Spark fuses the layers beneath it. ``plans.build`` writes the layers and wires stored tables instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.plans import dimensions, facts, growth, intermediate, revenue, staging

DAILY_PRODUCT_COLUMNS = (
    "user_id", "organization_id", "event_name", "event_count", "distinct_session_count", "first_event_at",
    "last_event_at",
)
DAILY_API_COLUMNS = (
    "organization_id", "is_organization_unknown", "request_count", "successful_request_count", "error_request_count",
    "error_rate", "total_input_units", "total_output_units", "total_estimated_cost", "avg_latency_ms",
)


class Warehouse:
    def __init__(
        self,
        raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
        as_of: datetime,
        usage_as_of: datetime | None = None,
        window_days: int = growth.USAGE_WINDOW_DAYS,
        unique_raw: bool = False,
        stored: Mapping[str, DataFrame] | None = None,
        activity: DataFrame | None = None,
        reread_raw: bool = False,
    ):
        self._raw = raw
        self.as_of = as_of
        self.usage_as_of = usage_as_of or as_of
        self.window_days = window_days
        self.unique_raw = unique_raw
        self.reread_raw = reread_raw  # stored landed tables with few repeated keys
        self._activity = activity  # what retention counts as activity, product usage by default
        # Tables already written win over the plans that would compute them.
        self._stored = dict(stored or {})
        self.__dict__.update(self._stored)

    def raw(self, source: str) -> DataFrame:
        frame = self._raw[source]
        return frame() if callable(frame) else frame

    def with_stored(self, stored: Mapping[str, DataFrame]) -> Warehouse:
        """The same warehouse over more stored tables."""
        return Warehouse(
            self._raw,
            self.as_of,
            self.usage_as_of,
            self.window_days,
            self.unique_raw,
            {**self._stored, **stored},
            self._activity,
            self.reread_raw,
        )

    def lands_by(self, source: str, day: str) -> bool:
        """Whether the rows of some days can be read alone: a duplicate could lie on a day that is left out."""
        return self.unique_raw and day in self.raw(source).columns

    def landed_days(self, source: str, day: str, days: list) -> Warehouse:
        """The same warehouse over some days of a source, if it landed partitioned by day.

        Only where landed rows are unique: a duplicate could lie on a day that is left out.
        """
        if not self.lands_by(source, day):
            return self
        part = {**self._raw, source: self.raw(source).filter(F.col(day).isin(days))}
        return Warehouse(part, self.as_of, self.usage_as_of, self.window_days, True)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    # staging
    @cached_property
    def stg_organizations(self):
        return staging.organizations(self.raw("organizations"), self.unique_raw, self.reread_raw)

    @cached_property
    def stg_users(self):
        return staging.users(self.raw("users"), self.unique_raw, self.reread_raw)

    @cached_property
    def stg_subscriptions(self):
        return staging.subscriptions(self.raw("subscriptions"), self.unique_raw, self.reread_raw)

    @cached_property
    def stg_invoices(self):
        # Invoices are delivered again as a matter of course, so their repeats are not few.
        return staging.invoices(self.raw("invoices"), self.unique_raw)

    @cached_property
    def stg_product_events(self):
        return staging.product_events(self.raw("product_events"), self.unique_raw, self.reread_raw)

    @cached_property
    def stg_api_usage(self):
        return staging.api_usage(self.raw("api_usage"), self.unique_raw, self.reread_raw)

    @cached_property
    def stg_crm_accounts(self):
        return staging.crm_accounts(self.raw("crm_accounts"), self.unique_raw, self.reread_raw)

    @cached_property
    def stg_marketing_events(self):
        return staging.marketing_events(self.raw("marketing_events"), self.unique_raw, self.reread_raw)

    # intermediate
    @cached_property
    def int_user_subscription_history(self):
        return intermediate.user_subscription_history(self.stg_subscriptions, self.stg_users)

    @cached_property
    def int_user_acquisition(self):
        return intermediate.user_acquisition(self.stg_users, self.stg_marketing_events)

    @cached_property
    def _revenue(self):
        return intermediate.customer_revenue(self.stg_invoices, self.stg_subscriptions)

    @cached_property
    def int_customer_revenue(self):
        return self._revenue.drop("_ingested_at")

    @cached_property
    def int_daily_product_usage(self):
        fact = self._stored.get("fact_product_usage")
        if fact is not None:  # the stored fact has the same rows, already aggregated
            return fact.select(F.col("date_day").alias("event_date"), *DAILY_PRODUCT_COLUMNS)
        return intermediate.daily_product_usage(self.stg_product_events)

    @cached_property
    def int_api_usage_by_customer(self):
        fact = self._stored.get("fact_api_usage")
        if fact is not None:
            return fact.select(F.col("date_day").alias("usage_date"), *DAILY_API_COLUMNS)
        return intermediate.api_usage_by_customer(self.stg_api_usage)

    @cached_property
    def int_subscription_transitions(self):
        return intermediate.subscription_transitions(self.stg_subscriptions)

    @cached_property
    def int_customer_activity(self):
        return intermediate.customer_activity(self.int_daily_product_usage, self.int_api_usage_by_customer)

    @cached_property
    def _milestones(self):
        return intermediate.subscription_milestones(self.stg_subscriptions)

    @cached_property
    def int_conversion_funnel(self):
        return intermediate.conversion_funnel(self.stg_users, self._milestones)

    @cached_property
    def int_customer_lifecycle(self):
        return intermediate.customer_lifecycle(self.stg_users, self._milestones)

    # dimensions
    @cached_property
    def dim_date(self):
        return dimensions.dim_date(
            self.stg_users,
            self.stg_subscriptions,
            self.stg_invoices,
            self.stg_product_events,
            self.stg_api_usage,
            self.as_of,
        )

    @cached_property
    def dim_organizations(self):
        return dimensions.dim_organizations(self.stg_organizations)

    @cached_property
    def dim_plans(self):
        return dimensions.dim_plans(self.stg_subscriptions)

    @cached_property
    def dim_users(self):
        return dimensions.dim_users(self.stg_users, self._milestones)

    # facts
    @cached_property
    def fact_subscriptions(self):
        return facts.fact_subscriptions(self.int_user_subscription_history, self.stg_organizations, self.as_of)

    # What the revenue marts read of a subscription: the stored fact, or just the lookups they need.
    @cached_property
    def _terms(self):
        fact = self._stored.get("fact_subscriptions")
        return facts.subscription_terms(self.stg_subscriptions, self.as_of) if fact is None else fact

    @cached_property
    def _terms_by_organization(self):
        fact = self._stored.get("fact_subscriptions")
        return facts.with_organization_key(self._terms, self.stg_organizations) if fact is None else fact

    @cached_property
    def fact_invoices(self):
        return facts.fact_invoices(self._revenue, self.stg_organizations)

    @cached_property
    def fact_product_usage(self):
        return facts.fact_product_usage(self.stg_product_events, self.stg_users, self.stg_organizations)

    @cached_property
    def fact_api_usage(self):
        return facts.fact_api_usage(self.stg_api_usage, self.stg_organizations)

    # growth marts
    @cached_property
    def mart_daily_growth(self):
        return growth.daily_growth(self.dim_date, self.stg_users, self.stg_organizations, self.as_of)

    @cached_property
    def mart_trial_conversion(self):
        return growth.trial_conversion(self.int_conversion_funnel, self.as_of)

    @cached_property
    def mart_acquisition_channels(self):
        # The stored fact has the user and the amounts of every invoice, so nothing is looked up again.
        fact = self._stored.get("fact_invoices")
        return growth.acquisition_channels(self.stg_users, self._milestones, self._revenue if fact is None else fact)

    @cached_property
    def mart_retention_cohorts(self):
        activity = self.int_daily_product_usage if self._activity is None else self._activity
        return growth.retention_cohorts(self.stg_users, activity, self.as_of)

    @cached_property
    def mart_feature_adoption(self):
        return growth.feature_adoption(self.int_daily_product_usage, self.stg_users)

    @cached_property
    def mart_enterprise_growth(self):
        return growth.enterprise_growth(
            self.dim_organizations,
            self._terms_by_organization,
            self.fact_product_usage,
            self.fact_api_usage,
            self.as_of,
            self.usage_as_of,
            self.window_days,
        )

    # revenue marts
    @cached_property
    def mart_mrr(self):
        return revenue.mrr(self._terms, self.as_of)

    @cached_property
    def mart_arr(self):
        return revenue.arr(self._terms, self.as_of)

    @cached_property
    def mart_arpu(self):
        return revenue.arpu(self._terms_by_organization, self.as_of)

    @cached_property
    def mart_customer_churn(self):
        return revenue.customer_churn(self.stg_subscriptions, self.stg_organizations, self.as_of)

    @cached_property
    def mart_revenue_churn(self):
        return revenue.revenue_churn(self._terms, self.as_of)

    @cached_property
    def mart_customer_ltv(self):
        return revenue.customer_ltv(self.fact_invoices, self.mart_arpu, self.mart_customer_churn)

    @cached_property
    def mart_api_usage(self):
        return revenue.api_usage(self.fact_api_usage)
