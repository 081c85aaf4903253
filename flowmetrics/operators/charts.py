"""The table behind each figure: rows, order and text labels, ready to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics import fixed
from flowmetrics.functions.numbers import signed_percent_label, whole_number_label
from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.functions.timeparts import day_text, ordinal_in
from flowmetrics.names import NAMES, Names
from flowmetrics.operators.aggregate import annual_mean
from flowmetrics.operators.order import sorted_small
from flowmetrics.operators.reshape import present_periods


def period_bars(
    summary: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Mean per period in time order, with a whole-number label."""
    means = summary.groupBy(names.period).agg(F.avg(names.mean).alias(names.mean))
    return present_periods(means, calendar, names).select(
        "ordinal", names.period, names.mean, whole_number_label(F.col(names.mean)).alias("label")
    )


def monthly_lines(monthly: DataFrame, names: Names = NAMES) -> DataFrame:
    """One line per year: series name, month, mean."""
    return sorted_small(monthly, names.year, names.month).select(
        F.col(names.year).cast("string").alias("series"), names.month, names.mean
    )


def hourly_lines(hourly: DataFrame, names: Names = NAMES) -> DataFrame:
    """One line per period: series name, hour, mean."""
    return sorted_small(hourly, names.period, names.hour).select(
        F.col(names.period).alias("series"), names.hour, names.mean
    )


def daily_series(daily: DataFrame, names: Names = NAMES) -> DataFrame:
    """Daily means in order of date."""
    return sorted_small(daily.select(names.day, names.day_mean), names.day)


def annual_labels(annual: DataFrame, names: Names = NAMES) -> DataFrame:
    """Annual means with a signed percent label where there is a change."""
    label = signed_percent_label(F.col(names.annual_change)).alias("label")
    return sorted_small(annual, names.year).select(
        names.year, names.annual_mean, names.annual_change, label
    )


def annual_line(
    monthly: DataFrame, pre_round: int | None = None, names: Names = NAMES
) -> DataFrame:
    """Annual means, by default of unrounded monthly means, with a whole-number label."""
    label = whole_number_label(F.col(names.annual_mean)).alias("label")
    return annual_mean(monthly, pre_round, names=names).select(names.year, names.annual_mean, label)


def day_type_bars(day_types: DataFrame, names: Names = NAMES) -> DataFrame:
    """Day-type means in logical order with their ordinal."""
    ordinal = ordinal_in(F.col(names.day_type), fixed.DAY_TYPES).alias("ordinal")
    return sorted_small(day_types.select(ordinal, names.day_type, names.mean), "ordinal")


def top_day_bars(top: DataFrame, names: Names = NAMES) -> DataFrame:
    """Top days from low to high, the day as text."""
    return sorted_small(top, F.asc(names.day_mean), F.desc(names.day)).select(
        day_text(F.col(names.day)).alias(names.day), names.day_mean
    )
