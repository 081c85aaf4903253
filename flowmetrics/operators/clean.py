"""From raw rows to clean, labelled readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmetrics import fixed
from flowmetrics.functions.numbers import round_stable_text, to_number
from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.functions.timeparts import as_timestamp, day_of, in_years
from flowmetrics.names import NAMES, READING_COLUMNS, Names, ReadingColumns
from flowmetrics.schema import require_columns

_NTZ = T.TimestampNTZType()


def prune_columns(df: DataFrame, columns: Sequence[str] = tuple(fixed.RAW_COLUMNS)) -> DataFrame:
    """Keep the named columns; a missing one is an error before any job runs."""
    require_columns(df, columns, "prune_columns")
    return df.select(*columns)


def clean_readings(
    df: DataFrame,
    columns: ReadingColumns = READING_COLUMNS,
    years: tuple[int, int] | None = (fixed.FIRST_YEAR, fixed.LAST_YEAR),
    valid_flag: str = fixed.VALID_FLAG,
    keep: Sequence[str] = (),
    pattern: str = fixed.TIMESTAMP_PATTERN,
    names: Names = NAMES,
) -> DataFrame:
    """Usable readings only, as (time, value) plus the columns in ``keep``.

    Dropped: times that do not parse, values that are no number, rows whose flag is not
    ``valid_flag`` (a NULL flag is not), and times outside the inclusive year range.
    """
    flag = [columns.flag] if columns.flag else []
    require_columns(df, [columns.time, columns.value, *flag, *keep], "clean_readings")
    raw, dtype = F.col(columns.time), df.schema[columns.time].dataType
    time = as_timestamp(raw, dtype, pattern)
    wanted = []
    if columns.flag:
        wanted.append(F.col(columns.flag) == valid_flag)
    if years:
        # On the column as stored: typed bounds reach the Parquet filter, and text in the
        # default pattern sorts like the times it spells.
        stored = not isinstance(dtype, T.StringType) or pattern == fixed.TIMESTAMP_PATTERN
        wanted.append(in_years(raw, dtype, *years) if stored else in_years(time, _NTZ, *years))
    if wanted:
        df = df.where(reduce(and_, wanted))
    return df.select(
        time.alias(names.time), to_number(F.col(columns.value)).alias(names.value), *keep
    ).where(f"`{names.time}` IS NOT NULL AND `{names.value}` IS NOT NULL")


def filter_years(
    readings: DataFrame,
    first: int = fixed.FIRST_YEAR,
    last: int = fixed.LAST_YEAR,
    names: Names = NAMES,
) -> DataFrame:
    """Readings of an inclusive range of years.

    Where there is a year column, as in the folders of :func:`write_clean_readings`, it is held
    to the range too, so that only those years' folders are listed and opened.
    """
    dtype = readings.schema[names.time].dataType
    wanted = in_years(F.col(names.time), dtype, first, last)
    if names.year in readings.columns:
        wanted = F.col(names.year).between(first, last) & wanted
    return readings.where(wanted)


def _calendar_parts(names: Names) -> dict[str, Column]:
    ts = F.col(names.time)
    return {
        names.year: F.year(ts),
        names.month: F.month(ts),
        names.hour: F.hour(ts),
        names.day: day_of(ts),
    }


def add_calendar(readings: DataFrame, names: Names = NAMES) -> DataFrame:
    """Add year, month, hour and day of the reading time."""
    return readings.withColumns(_calendar_parts(names))


def label_period(
    df: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Add the period label of the day column."""
    return df.withColumn(names.period, calendar.label(f"`{names.day}`"))


def label_period_by_join(
    df: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Same labels as ``label_period``, and the same columns in the same order, by a join.

    Bounded periods are spelled out to one row per day, so the range condition becomes an
    equality on the day and each row probes one hash table. The day table is always broadcast:
    it has the days of a calendar, about 50 bytes each, however large ``df`` is, and ``df`` is
    never shuffled.
    """
    day = F.col(names.day)
    if not calendar.closed:
        return label_period(df, calendar, names)
    first_label, first_last_day = calendar.closed[0]
    days = calendar.day_frame(df.sparkSession, names.day, "_label")
    label = F.coalesce(
        F.col("_label"),
        F.when(day <= F.lit(first_last_day), first_label),
        F.lit(calendar.open_label),
    )
    joined = df.join(F.broadcast(days), names.day, "left")
    columns = [c for c in df.columns if c != names.period]
    return joined.select(*columns, label.alias(names.period))


def prepare_readings(
    df: DataFrame,
    columns: ReadingColumns = READING_COLUMNS,
    years: tuple[int, int] | None = (fixed.FIRST_YEAR, fixed.LAST_YEAR),
    valid_flag: str = fixed.VALID_FLAG,
    calendar: PeriodCalendar = DEFAULT_CALENDAR,
    names: Names = NAMES,
) -> DataFrame:
    """Clean, add calendar columns and label: the input of every first-tier aggregate."""
    clean = clean_readings(df, columns, years, valid_flag, names=names)
    return label_readings(clean, calendar, names)


def label_readings(
    clean: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Add calendar columns and the period label to clean readings."""
    parts = _calendar_parts(names)
    return clean.withColumns(parts | {names.period: calendar.label_at(f"`{names.time}`")})


def round_columns(
    df: DataFrame, columns: Sequence[str], decimals: int = fixed.DECIMALS
) -> DataFrame:
    """Round the named columns that are present; the others are ignored."""
    names = df.columns
    present = {c: F.expr(round_stable_text(c, decimals)) for c in columns if c in names}
    return df.withColumns(present) if present else df
