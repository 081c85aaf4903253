"""Matrices, logical order and the selection of known periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.names import NAMES, Names
from flowmetrics.operators.order import sorted_small
from flowmetrics.sources.scratch import scratch_path, written


def _single_cell(value: str) -> Column:
    """The value of a matrix cell; two rows for one cell are an error, not a guess."""
    cell = F.max(value)
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate matrix cell"))).otherwise(
        cell
    )


def matrix(
    df: DataFrame, rows: str, columns: str, value: str, values: Sequence | None
) -> DataFrame:
    """One row per ``rows`` key and one column per entry of ``values``; missing cells are NULL.

    Without ``values`` Spark runs one more job to find the column keys.
    """
    groups = df.groupBy(rows)
    pivot = groups.pivot(columns) if values is None else groups.pivot(columns, list(values))
    return sorted_small(pivot.agg(_single_cell(value)), rows)


def pivot_month_year(
    monthly: DataFrame, years: Sequence[int] | None, names: Names = NAMES
) -> DataFrame:
    """Month by year matrix of the monthly means.

    ``years`` names the columns; ``None`` asks for a job that collects the table's years.
    """
    return matrix(monthly, names.month, names.year, names.mean, years)


def pivot_hour_period(
    hourly: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Hour by period matrix of the hourly curve, periods in time order."""
    return matrix(hourly, names.hour, names.period, names.mean, calendar.labels)


def logical_order(
    df: DataFrame,
    calendar: PeriodCalendar = DEFAULT_CALENDAR,
    then: Sequence[str] = (),
    names: Names = NAMES,
) -> DataFrame:
    """Add the period's ordinal and sort by it; labels not in the calendar come last."""
    ordinal = calendar.ordinal_of(names.period)
    return sorted_small(df.withColumn("ordinal", ordinal), F.asc_nulls_last("ordinal"), *then)


def present_periods(
    df: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Rows of the calendar's periods in time order.

    When not one label is in the calendar, all rows in order of their text. Takes a table with
    one row per period, which is written first: whether any of its labels is known is a scalar of
    the written rows.
    """
    rows = df.withColumn("ordinal", calendar.ordinal_of(names.period))
    rows = written(rows, scratch_path(df.sparkSession, "periods"))
    known = rows.agg(F.count("ordinal")).scalar()
    kept = rows.where(F.col("ordinal").isNotNull() | (known == 0))
    return sorted_small(kept, F.asc_nulls_last("ordinal"), names.period)
