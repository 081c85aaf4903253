"""Column expressions; all of them stay on the JVM side."""

from flowmetrics.functions.numbers import (
    nan_to_null,
    pct_change,
    round_stable,
    signed_percent_label,
    to_number,
    whole_number_label,
)
from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.functions.timeparts import (
    as_timestamp,
    day_of,
    day_text,
    day_type,
    in_years,
    ordinal_in,
    parse_day,
    parse_timestamp,
    second_text,
    truncate_day,
    weekday_number,
)

__all__ = [
    "DEFAULT_CALENDAR",
    "PeriodCalendar",
    "as_timestamp",
    "day_of",
    "day_text",
    "day_type",
    "in_years",
    "nan_to_null",
    "ordinal_in",
    "parse_day",
    "parse_timestamp",
    "pct_change",
    "round_stable",
    "second_text",
    "signed_percent_label",
    "to_number",
    "truncate_day",
    "weekday_number",
    "whole_number_label",
]
