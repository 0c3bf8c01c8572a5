"""Column functions: every one maps Columns to a Column and runs inside generated code."""

from meterbook.functions.arithmetic import (  # noqa: F401
    monthly_amount,
    outstanding_amount,
    paid_amount,
    rounded,
    safe_divide,
)
from meterbook.functions.cleaning import (  # noqa: F401
    blank_to_null,
    closed_vocabulary,
    is_country_code_recognized,
    is_currency_recognized,
    is_email_valid,
    is_success_status,
    json_field,
    normalize_country_code,
    normalize_currency,
    normalize_email,
    normalize_text,
    safe_integer,
    safe_numeric,
    safe_timestamp,
)
from meterbook.functions.keys import packed_key, surrogate_key, unpacked_key  # noqa: F401
from meterbook.functions.subscriptions import (  # noqa: F401
    active_at,
    is_paid_plan,
    recurring_active,
)
from meterbook.functions.timing import (  # noqa: F401
    age_in_hours,
    calendar_columns,
    date_literal,
    elapsed_days,
    in_trailing_days,
    month_start,
    months_between_starts,
    time_literal,
)
