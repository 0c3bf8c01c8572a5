"""Money and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money lands as decimal(18,2); widened before dividing so that a twelfth keeps 15 digits and the
# sum of billions of twelfths still rounds to the right cent.
WIDE_MONEY = "decimal(28,12)"


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """FN-10: NULL where the denominator is NULL or 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def monthly_amount(amount: Column, billing_interval: Column) -> Column:
    """FN-11: calendar months; an interval that is neither monthly nor annual gives NULL."""
    wide = amount.cast(WIDE_MONEY)
    twelfth = wide / F.lit(12)
    return F.when(billing_interval == "monthly", wide).when(billing_interval == "annual", twelfth)


def paid_amount(status: Column, total: Column) -> Column:
    """FN-26: collected money."""
    return F.when(status == "paid", total).otherwise(F.lit(0).cast("decimal(18,2)"))


def outstanding_amount(status: Column, total: Column) -> Column:
    """FN-26: billed, still waiting."""
    return F.when(status.isin("open", "failed"), total).otherwise(F.lit(0).cast("decimal(18,2)"))


def rounded(c: Column, digits: int = 2) -> Column:
    """FN-29."""
    return F.round(c, digits)
