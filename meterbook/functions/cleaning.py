"""Cleaning of landed text: trimming, vocabularies, and casts that turn bad input into NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean one country, the known countries and the known currencies.
US_SPELLINGS = ("US", "USA", "UNITED STATES")
GB_SPELLINGS = ("GB", "UK", "UNITED KINGDOM")
KNOWN_COUNTRIES = ("US", "GB", "DE", "FR", "CA", "AU", "NL", "IN", "BR", "JP", "ES", "IT")
KNOWN_CURRENCIES = ("USD", "EUR", "GBP")
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+\z"

UNKNOWN = "unknown"


def normalize_text(c: Column, lower: bool = False) -> Column:
    """FN-01: strip spaces; lower-case only where case means nothing."""
    return F.lower(F.trim(c)) if lower else F.trim(c)


def normalize_email(c: Column) -> Column:
    """FN-02."""
    return F.lower(F.trim(c))


def is_email_valid(c: Column) -> Column:
    """FN-03: the shape of an address. ``\\z`` because ``$`` lets a trailing newline pass."""
    return c.isNotNull() & c.rlike(EMAIL_SHAPE)


def normalize_country_code(c: Column) -> Column:
    """FN-04."""
    code = F.upper(F.trim(c))
    return F.when(code.isin(*US_SPELLINGS), "US").when(code.isin(*GB_SPELLINGS), "GB").otherwise(code)


def is_country_code_recognized(code: Column) -> Column:
    """FN-05: NULL in, NULL out."""
    return code.isin(*KNOWN_COUNTRIES)


def normalize_currency(c: Column) -> Column:
    """FN-06: no conversion between currencies, here or anywhere."""
    return F.upper(F.trim(c))


def is_currency_recognized(code: Column) -> Column:
    """FN-07."""
    return code.isin(*KNOWN_CURRENCIES)


def safe_numeric(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """FN-08: a decimal, or NULL where the text is no number. Never 0."""
    return F.trim(c).try_cast(f"decimal({precision},{scale})")


def safe_integer(c: Column) -> Column:
    """FN-08: a whole number, or NULL. The shape test keeps "3.7" and "1e3" out in every mode."""
    text = F.trim(c)
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint"))


# Dates that are not ``yyyy-mm-dd...``: how they are written, in the order they are tried.
OTHER_DATES = {
    r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}": "yyyy/M/d",
    r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}": "yyyy/M/d H:mm:ss",
    r"[0-9]{8}": "yyyyMMdd",
    r"[0-9]{8}T[0-9]{6}": "yyyyMMdd'T'HHmmss",
}


def safe_timestamp(c: Column) -> Column:
    """FN-09: a timestamp, or NULL.

    The cast alone accepts "now" (whose value changes) and "2025", so the text must first look like
    ``yyyy-mm-dd...``. Plain position tests are used since they are much cheaper than a pattern; only
    text that fails them is held against the other ways to write a date.
    """
    text = F.trim(c)
    dated = (F.length(text) >= 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    found = F.when(dated, text.try_cast("timestamp"))
    for shape, written in OTHER_DATES.items():
        found = found.when(text.rlike(rf"^{shape}\z"), F.try_to_timestamp(text, F.lit(written)))
    return found


def closed_vocabulary(c: Column, allowed: Sequence[str]) -> Column:
    """FN-13: a member of the vocabulary, else "unknown" (NULL included)."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*allowed), word).otherwise(F.lit(UNKNOWN))


def blank_to_null(c: Column, lower: bool = False) -> Column:
    """FN-14."""
    return F.nullif(normalize_text(c, lower), F.lit(""))


def is_success_status(status_code: Column) -> Column:
    """FN-16: a missing status is neither success nor error."""
    return status_code.between(200, 299)


def json_field(properties: Column, field: str) -> Column:
    """FN-28: one key of a JSON document that is otherwise kept whole."""
    return F.get_json_object(properties, f"$.{field}")
