from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterbook import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text,expected",
    [("a@b.co", True), ("a@b", False), ("a b@c.co", False), ("a@b@c.co", False), ("a@b.co\n", False), (None, False)],
)
def test_email_shape(spark, text, expected):
    assert one(spark, fn.is_email_valid(F.lit(text).cast("string"))) is expected


@pytest.mark.parametrize(
    "text,expected", [(" usa", "US"), ("United Kingdom", "GB"), ("de ", "DE"), ("zz", "ZZ"), (None, None)]
)
def test_country(spark, text, expected):
    assert one(spark, fn.normalize_country_code(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text,expected", [(" 12 ", 12), ("3.7", None), ("1e3", None), ("", None), ("-4", -4)])
def test_integer_or_null(spark, text, expected):
    assert one(spark, fn.safe_integer(F.lit(text))) == expected


@pytest.mark.parametrize("text,expected", [(" 12.345 ", "12.35"), ("NaN", None), ("x", None), ("", None)])
def test_numeric_or_null(spark, text, expected):
    value = one(spark, fn.safe_numeric(F.lit(text)))
    assert (None if value is None else str(value)) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
        (" 2024-01-02 03:04:05+02 ", datetime(2024, 1, 2, 1, 4, 5)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("2024-02-30", None),
        ("now", None),
        ("2025", None),
        ("tomorrow!!", None),
    ],
)
def test_timestamp_or_null(spark, text, expected):
    assert one(spark, fn.safe_timestamp(F.lit(text))) == expected


def test_vocabulary_and_blanks(spark):
    assert one(spark, fn.closed_vocabulary(F.lit(" Paid"), ("paid",))) == "paid"
    assert one(spark, fn.closed_vocabulary(F.lit(None).cast("string"), ("paid",))) == "unknown"
    assert one(spark, fn.blank_to_null(F.lit("  "))) is None


def test_division_by_zero_or_null_is_null(spark):
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(4))) == 0.25


def test_monthly_amount(spark):
    amount = F.lit("100.00").cast("decimal(18,2)")
    assert one(spark, fn.monthly_amount(amount, F.lit("monthly"))) == 100
    assert round(float(one(spark, fn.monthly_amount(amount, F.lit("annual")))), 6) == 8.333333
    assert one(spark, fn.monthly_amount(amount, F.lit("weekly"))) is None


def test_elapsed_days_truncate_toward_zero(spark):
    start = F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert one(spark, fn.elapsed_days(start, F.lit("2024-01-03 06:00:00").cast("timestamp"))) == 1
    assert one(spark, fn.elapsed_days(start, F.lit("2023-12-31 00:00:00").cast("timestamp"))) == -1


def test_trailing_days_cover_the_last_day_and_not_the_one_before_the_first(spark):
    def inside(day, skip=0):
        return one(spark, fn.in_trailing_days(F.lit(day).cast("date"), date(2024, 1, 31), 30, skip))

    assert inside("2024-01-31") and inside("2024-01-02") and not inside("2024-01-01")
    assert inside("2024-01-01", skip=30) and not inside("2024-01-02", skip=30)


def test_calendar_of_an_iso_year_end(spark):
    day = spark.range(1).select(F.lit("2021-01-03").cast("date").alias("d"))
    got = day.select(*fn.calendar_columns(F.col("d"))).first()
    assert (got["week_number"], got["day_of_week_number"], got["is_weekend"]) == (53, 7, True)
    assert got["month_label"] == "2021-01"


def test_surrogate_key_tells_null_from_blank(spark):
    null, blank = F.lit(None).cast("string"), F.lit("")
    assert one(spark, fn.surrogate_key(null)) != one(spark, fn.surrogate_key(blank))


def test_recurring_active_keeps_future_cancellations(spark):
    as_of = datetime(2024, 6, 1)

    def active(status, cancelled):
        return one(spark, fn.recurring_active(F.lit(status), F.lit(cancelled).cast("timestamp"), as_of))

    assert active("active", None) is True
    assert active("canceled", "2024-07-01") is True
    assert active("canceled", "2024-05-01") is False
    assert active("canceled", None) is None
    assert active("past_due", None) is False


def test_other_ways_to_write_a_date(spark):
    from datetime import datetime as t

    from meterbook.functions import safe_timestamp

    cases = {
        "2025/01/02": t(2025, 1, 2), " 2025/1/2 ": t(2025, 1, 2), "2025/01/02 3:04:05": t(2025, 1, 2, 3, 4, 5),
        "20250102": t(2025, 1, 2), "20250102T030405": t(2025, 1, 2, 3, 4, 5), "2025-01-02": t(2025, 1, 2),
        "20251302": None, "2025/02/30": None, "2025": None, "now": None, "": None, "2025/01/02x": None, None: None,
    }
    frame = spark.createDataFrame([(k,) for k in cases], "text string")
    got = {r[0]: r[1] for r in frame.select("text", safe_timestamp(F.col("text"))).collect()}
    assert got == cases
