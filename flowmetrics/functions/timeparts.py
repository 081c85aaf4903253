"""Column expressions on reading times and days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmetrics import fixed

_DEFAULT_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_timestamp(c: Column, pattern: str = fixed.TIMESTAMP_PATTERN) -> Column:
    """Text to a wall-clock timestamp; text that does not fit the pattern becomes NULL.

    The default pattern never passes through the session time zone, so an hour that a clock
    change skips or repeats is kept as written. Any other pattern is read by Spark's
    formatter in the session time zone.
    """
    if pattern == fixed.TIMESTAMP_PATTERN:
        return F.when(c.rlike(_DEFAULT_SHAPE), c.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def as_timestamp(c: Column, dtype: T.DataType, pattern: str = fixed.TIMESTAMP_PATTERN) -> Column:
    """Wall-clock timestamp from text (parsed) or from a date or timestamp column (cast)."""
    if isinstance(dtype, T.StringType):
        return parse_timestamp(c, pattern)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    return c.cast("timestamp_ntz")


def in_years(c: Column, dtype: T.DataType, first: int, last: int) -> Column:
    """Inclusive year range as a half-open range in the column's own type, so it is pushed down.

    ``year(ts) BETWEEN ...`` says the same but reaches no Parquet filter.
    """
    low = F.lit(f"{first:04d}-01-01 00:00:00").cast(dtype)
    high = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast(dtype)
    return (c >= low) & (c < high)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def truncate_day(ts: Column) -> Column:
    """Midnight of the same day, as a wall-clock timestamp."""
    return F.to_date(ts).cast("timestamp_ntz")


def parse_day(c: Column) -> Column:
    """ISO day text to a date; other text becomes NULL."""
    return F.try_to_date(c, fixed.DAY_PATTERN)


def day_text(day: Column) -> Column:
    """Day of a date or wall-clock time as ISO text."""
    return F.to_date(day).cast("string")


def second_text(ts: Column) -> Column:
    """Wall-clock time to the second as text in the default pattern, in no time zone."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def weekday_number(day: Column) -> Column:
    """Day of the week, Monday = 0."""
    return F.weekday(day)


def day_type(day: Column) -> Column:
    """Type of a day: Monday to Friday, Saturday, and the rest as Sunday."""
    n = weekday_number(day)
    return (
        F.when(n < 5, fixed.WEEKDAY_TYPE)
        .when(n == 5, fixed.SATURDAY_TYPE)
        .otherwise(fixed.SUNDAY_TYPE)
    )


def ordinal_in(c: Column, labels: list[str]) -> Column:
    """1-based position of a label in a list of labels, NULL when it is not there."""
    order = F.array(*[F.lit(x) for x in labels])
    return F.nullif(F.array_position(order, c).cast("int"), F.lit(0))


def iso_date(text: str | date) -> date:
    return text if isinstance(text, date) else date.fromisoformat(text)
