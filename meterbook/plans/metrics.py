"""QRY-18: metrics by id. Each states where it comes from, its grain and the filters it takes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from meterbook.operators.paging import DEFAULT_PAGE_SIZE, Page
from meterbook.plans import reads
from meterbook.plans.warehouse import Warehouse


@dataclass(frozen=True)
class MetricSources:
    """What a lookup may read."""

    warehouse: Warehouse
    quality_runs: DataFrame | None = None
    quality_results: DataFrame | None = None

    @property
    def today(self):
        return self.warehouse.as_of.date()

    @property
    def usage_today(self):
        """Usage events have a clock of their own."""
        return self.warehouse.usage_as_of.date()


@dataclass(frozen=True)
class Metric:
    metric_id: str
    source: str
    grain: str
    query: Callable[[MetricSources, dict[str, Any], int], DataFrame | Page]
    optional: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    point_in_time: bool = False  # a snapshot as of one moment, not a series
    dated: bool = False  # takes start and end, the last 30 days by default


def _quality(sources: MetricSources) -> tuple[DataFrame, DataFrame]:
    if sources.quality_runs is None or sources.quality_results is None:
        raise ValueError("no quality history is available")
    return sources.quality_runs, sources.quality_results


def _detail(sources: MetricSources, given: dict[str, Any], limit: int) -> DataFrame:
    w = sources.warehouse
    return reads.customer_detail(
        given["organization_id"], w.dim_organizations, w.fact_subscriptions, w.mart_customer_ltv,
        w.fact_product_usage, w.fact_api_usage, as_of=w.usage_as_of, window_days=w.window_days,
    )


_WINDOW = ("start", "end")

# Metric ids, their sources and grains.
METRICS: dict[str, Metric] = {
    m.metric_id: m
    for m in (
        Metric(
            "daily_growth", "mart_daily_growth", "calendar day",
            lambda s, f, n: reads.daily_growth(s.warehouse.mart_daily_growth, s.today, **f),
            optional=_WINDOW, dated=True,
        ),
        Metric(
            "acquisition_channels", "mart_acquisition_channels", "acquisition_channel, currency",
            lambda s, f, n: reads.acquisition_channels(s.warehouse.mart_acquisition_channels, f.get("acquisition_channel")),
            optional=("acquisition_channel",),
        ),
        Metric(
            "trial_conversion", "mart_trial_conversion", "user who tried",
            lambda s, f, n: reads.trial_conversion(s.warehouse.mart_trial_conversion, limit=n, **f),
            optional=("is_converted", "is_observation_complete"),
        ),
        Metric(
            "retention_cohorts", "mart_retention_cohorts", "cohort_month, period_index",
            lambda s, f, n: reads.retention_cohorts(s.warehouse.mart_retention_cohorts, **f),
            optional=("cohort_month",),
        ),
        Metric(
            "feature_adoption", "mart_feature_adoption", "event_name",
            lambda s, f, n: reads.feature_adoption(s.warehouse.mart_feature_adoption, **f),
            optional=("event_name",),
        ),
        Metric(
            "mrr", "mart_mrr", "currency",
            lambda s, f, n: reads.by_currency(s.warehouse.mart_mrr, **f),
            optional=("currency",), point_in_time=True,
        ),
        Metric(
            "arr", "mart_arr", "currency",
            lambda s, f, n: reads.by_currency(s.warehouse.mart_arr, **f),
            optional=("currency",), point_in_time=True,
        ),
        Metric(
            "customer_churn", "mart_customer_churn", "period, organization_type",
            lambda s, f, n: reads.churn(s.warehouse.mart_customer_churn, **f),
            optional=("organization_type",),
        ),
        Metric(
            "arpu", "mart_arpu", "currency",
            lambda s, f, n: reads.by_currency(s.warehouse.mart_arpu, **f),
            optional=("currency",), point_in_time=True,
        ),
        Metric(
            "customer_ltv", "mart_customer_ltv", "organization_id, currency",
            lambda s, f, n: reads.customer_ltv(
                s.warehouse.mart_customer_ltv, s.warehouse.dim_organizations, limit=n, **f
            ),
            optional=("currency",), point_in_time=True,
        ),
        Metric(
            "api_usage", "mart_api_usage", "month_start_date, organization_id",
            lambda s, f, n: reads.api_usage(
                s.warehouse.mart_api_usage, s.warehouse.dim_organizations, s.usage_today, limit=n, **f
            ),
            optional=(*_WINDOW, "organization_id"), dated=True,
        ),
        Metric(
            "customer_detail", "dim_organizations, fact_subscriptions, mart_customer_ltv, usage facts",
            "organization_id", _detail, required=("organization_id",),
        ),
        Metric(
            "quality_latest", "quality_runs, data_quality_results", "quality run",
            lambda s, f, n: reads.latest_quality_run(*_quality(s)), point_in_time=True,
        ),
        Metric(
            "quality_run_detail", "quality_runs, data_quality_results", "quality run",
            lambda s, f, n: reads.quality_run_detail(*_quality(s), **f), required=("run_id",), point_in_time=True,
        ),
    )
}


def lookup_metric(
    sources: MetricSources, metric_id: str, limit: int = DEFAULT_PAGE_SIZE, **filters: Any
) -> DataFrame | Page:
    """The rows of a metric. An unknown id, a filter it does not take or a missing one is an error."""
    metric = METRICS.get(metric_id)
    if metric is None:
        raise ValueError(f"unknown metric '{metric_id}'")
    given = {name: value for name, value in filters.items() if value is not None}
    missing = [name for name in metric.required if name not in given]
    if missing:
        raise ValueError(f"{metric_id} needs {', '.join(missing)}")
    surplus = [name for name in given if name not in (*metric.optional, *metric.required)]
    if surplus:
        raise ValueError(f"{metric_id} does not take {', '.join(surplus)}")
    return metric.query(sources, given, limit)
