"""Predicates on a subscription's state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterbook.functions.timing import time_literal


def recurring_active(status: Column, cancelled_at: Column, as_of: datetime) -> Column:
    """FN-12: pays now. A cancellation that lies ahead still pays; past_due and trialing do not."""
    return (status == "active") | ((status == "canceled") & (cancelled_at > time_literal(as_of)))


def active_at(started_at: Column, cancelled_at: Column, moment: Column) -> Column:
    """FLT-05: had started and was not yet cancelled at ``moment``, whatever the status is today."""
    return (started_at <= moment) & (cancelled_at.isNull() | (cancelled_at > moment))


def is_paid_plan(plan_name: Column) -> Column:
    """FLT-02."""
    return plan_name.isNotNull() & (plan_name != F.lit("free"))
