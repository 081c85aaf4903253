"""Time-stamped sensor readings on Spark: named periods, calendar means, comparisons."""

from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.names import NAMES, READING_COLUMNS, Names, ReadingColumns

__all__ = [
    "DEFAULT_CALENDAR",
    "NAMES",
    "Names",
    "PeriodCalendar",
    "READING_COLUMNS",
    "ReadingColumns",
]
