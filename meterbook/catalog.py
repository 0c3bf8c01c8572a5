"""Every query by name, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbook.functions import json_field
from meterbook.scenarios import SCENARIOS
from meterbook.session import apply_settings
from meterbook.sources.bindings import Bindings

MODELS = (
    "stg_organizations", "stg_users", "stg_subscriptions", "stg_invoices", "stg_product_events", "stg_api_usage",
    "stg_crm_accounts", "stg_marketing_events",
    "int_user_subscription_history", "int_user_acquisition", "int_customer_revenue", "int_daily_product_usage",
    "int_api_usage_by_customer", "int_subscription_transitions", "int_customer_activity", "int_conversion_funnel",
    "int_customer_lifecycle",
    "dim_date", "dim_organizations", "dim_plans", "dim_users",
    "fact_subscriptions", "fact_invoices", "fact_product_usage", "fact_api_usage",
    "mart_daily_growth", "mart_trial_conversion", "mart_acquisition_channels", "mart_retention_cohorts",
    "mart_feature_adoption", "mart_enterprise_growth",
    "mart_mrr", "mart_arr", "mart_arpu", "mart_customer_churn", "mart_revenue_churn", "mart_customer_ltv",
    "mart_api_usage",
)


def _model(name: str) -> Callable[[Bindings], DataFrame]:
    return lambda bindings: bindings.warehouse().table(name)


def _event_properties(bindings: Bindings) -> DataFrame:
    """FN-28: one key read out of the JSON documents."""
    events = bindings.warehouse().stg_product_events
    k = json_field(F.col("properties"), "k").cast("bigint").alias("k")
    return events.groupBy("event_name", k).agg(F.count("*").alias("rows"))


QUERIES: dict[str, Callable[[Bindings], DataFrame]] = {
    **{name: _model(name) for name in MODELS},
    "event_properties": _event_properties,
    **SCENARIOS,
}

_SIX_DIGITS = ("_rate", "_pct", "_cost", "_hours")


def _digits(column: str) -> int:
    if column == "estimated_ltv":
        return 2
    return 6 if column.endswith(_SIX_DIGITS) else 4


def comparable(df: DataFrame) -> DataFrame:
    """Numbers in the two shapes both engines share: 64-bit whole numbers and rounded doubles."""
    shown = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint").alias(field.name)
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c, _digits(field.name)).cast("double").alias(field.name)
        shown.append(c)
    return df.select(*shown)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return comparable(QUERIES[name](Bindings(apply_settings(spark), folder)))
