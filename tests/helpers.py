"""Small landed tables. A row gives the columns it cares about; the others are NULL."""

from datetime import datetime

from pyspark.sql import functions as F

from meterbook.sources.registry import SOURCES

AS_OF = datetime(2024, 6, 1)


def raw(spark, source, *rows):
    columns = SOURCES[source].columns
    data = [tuple(r.get(c) for c in columns) + (r.get("_ingested_at", "2024-05-01 00:00:00"),) for r in rows]
    schema = ", ".join(f"{c} string" for c in (*columns, "_at"))
    return (
        spark.createDataFrame(data, schema)
        .withColumn("_ingested_at", F.col("_at").cast("timestamp"))
        .drop("_at")
        .withColumns({"_source_file": F.lit("f"), "_run_id": F.lit("r")})
    )


def sub(key, **values):
    base = dict(
        subscription_id=key, user_id="u1", organization_id="o1", plan_name="pro", billing_interval="monthly",
        status="active", currency="USD", amount="100.00", started_at="2024-01-01T00:00:00Z",
        updated_at="2024-01-01T00:00:00Z",
    )
    return {**base, **values}


def org(key, kind="business"):
    return dict(organization_id=key, organization_type=kind, created_at="2023-01-01T00:00:00Z")


def user(key, organization="o1", signup="2024-01-01T00:00:00Z", **values):
    return dict(user_id=key, organization_id=organization, signup_at=signup, **values)


def event(key, at, user_id="u1", **values):
    base = dict(
        event_id=key, user_id=user_id, organization_id="o1", event_name="view", event_timestamp=at, session_id="s",
        properties="{}",
    )
    return {**base, **values}


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
