"""The whole job: readings to first-tier tables, derived tables, report and figure tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from flowmetrics import fixed
from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.names import NAMES, READING_COLUMNS, Names, ReadingColumns
from flowmetrics.operators import charts
from flowmetrics.operators.aggregate import (
    day_type_mean,
    means_from_rollup,
    period_summary,
    rollup_and_cut,
    sketched_rollup,
    summary_from_sketches,
    with_rollup_keys,
)
from flowmetrics.operators.clean import clean_readings, label_readings
from flowmetrics.operators.compare import annual_change, baseline_comparison
from flowmetrics.operators.distribution import distribution_by_period
from flowmetrics.operators.order import sorted_small
from flowmetrics.operators.rank import bottom_days, top_days
from flowmetrics.operators.reshape import pivot_hour_period, pivot_month_year
from flowmetrics.sources.scratch import scratch_folder, scratch_path, written
from flowmetrics.sources.tables import load_tables, rounded_tables, write_tables


def first_tier(
    readings: DataFrame,
    calendar: PeriodCalendar = DEFAULT_CALENDAR,
    median: str = "exact",
    work_dir: str | None = None,
    names: Names = NAMES,
) -> dict[str, DataFrame]:
    """Period summary, monthly, hourly and daily tables of prepared readings.

    One scan of the readings makes a day-hour rollup, written below ``work_dir`` (by default a
    new scratch path), that the three tables of means share. With ``median="approx"`` the rollup
    holds sketches and the summary comes from it, too; for the exact summary the same scan counts
    by value slots, and one more scan looks into them. Nothing as large as the readings is kept.
    """
    work_dir = work_dir or scratch_path(readings.sparkSession, "first-tier")
    if median == "approx":
        made = sketched_rollup(readings, [], names=names)
        rollup = written(made, f"{work_dir}/rollup")
        summary = summary_from_sketches(with_rollup_keys(rollup, calendar, names), names)
        summary = sorted_small(summary, names.period)
    else:
        rollup, cut = rollup_and_cut(readings, f"{work_dir}/rollup", names)
        summary = period_summary(readings, median, names=names, cut=cut)
    return {fixed.SUMMARY_TABLE: summary, **means_from_rollup(rollup, calendar, names)}


def basic_report(
    base: Mapping[str, DataFrame], decimals: int = fixed.DECIMALS, names: Names = NAMES
) -> dict[str, DataFrame]:
    """The four first-tier tables, rounded, under their report names."""
    rounded = rounded_tables(base, decimals, names)
    return {
        fixed.REPORT_SUMMARY: rounded[fixed.SUMMARY_TABLE],
        fixed.REPORT_MONTHLY: rounded[fixed.MONTHLY_TABLE],
        fixed.REPORT_HOURLY: rounded[fixed.HOURLY_TABLE],
        fixed.REPORT_DAILY: rounded[fixed.DAILY_TABLE],
    }


def full_report(
    base: Mapping[str, DataFrame],
    n: int = fixed.TOP_N,
    baseline: str = fixed.BASELINE_PERIOD,
    decimals: int = fixed.DECIMALS,
    names: Names = NAMES,
) -> dict[str, DataFrame]:
    """The basic report and the five tables derived from its rounded values."""
    report = basic_report(base, decimals, names)
    daily = report[fixed.REPORT_DAILY]
    report[fixed.REPORT_ANNUAL] = annual_change(report[fixed.REPORT_MONTHLY], None, names)
    report[fixed.REPORT_DAY_TYPE] = day_type_mean(daily, None, decimals, names)
    report[fixed.REPORT_TOP] = top_days(daily, n, None, names)
    report[fixed.REPORT_BOTTOM] = bottom_days(daily, n, None, names)
    report[fixed.REPORT_COMPARISON] = baseline_comparison(
        report[fixed.REPORT_SUMMARY], baseline, decimals, None, names
    )
    return report


def figure_tables(
    base: Mapping[str, DataFrame],
    report: Mapping[str, DataFrame],
    calendar: PeriodCalendar,
    years: Sequence[int],
    n: int = fixed.TOP_N,
    names: Names = NAMES,
) -> dict[str, DataFrame]:
    """The table behind every figure: the report's use rounded values, ``raw_*`` do not."""
    monthly, hourly = base[fixed.MONTHLY_TABLE], base[fixed.HOURLY_TABLE]
    daily = base[fixed.DAILY_TABLE]
    return {
        "period_bars": charts.period_bars(report[fixed.REPORT_SUMMARY], calendar, names),
        "monthly_lines": charts.monthly_lines(report[fixed.REPORT_MONTHLY], names),
        "hourly_lines": charts.hourly_lines(report[fixed.REPORT_HOURLY], names),
        "daily_series": charts.daily_series(report[fixed.REPORT_DAILY], names),
        "annual_labels": charts.annual_labels(report[fixed.REPORT_ANNUAL], names),
        "day_type_bars": charts.day_type_bars(report[fixed.REPORT_DAY_TYPE], names),
        "top_day_bars": charts.top_day_bars(report[fixed.REPORT_TOP], names),
        "month_year": pivot_month_year(report[fixed.REPORT_MONTHLY], years, names),
        "hour_period": pivot_hour_period(report[fixed.REPORT_HOURLY], calendar, names),
        "raw_month_year": pivot_month_year(monthly, years, names),
        "raw_hour_period": pivot_hour_period(hourly, calendar, names),
        "raw_distribution": distribution_by_period(daily, calendar, names),
        "raw_day_type_bars": charts.day_type_bars(
            day_type_mean(daily, None, None, names), names
        ),
        "raw_top_day_bars": charts.top_day_bars(top_days(daily, n, None, names), names),
        "raw_annual_line": charts.annual_line(monthly, None, names),
    }


def run_report(
    raw: DataFrame,
    root: str,
    columns: ReadingColumns = READING_COLUMNS,
    years: tuple[int, int] = (fixed.FIRST_YEAR, fixed.LAST_YEAR),
    valid_flag: str = fixed.VALID_FLAG,
    calendar: PeriodCalendar = DEFAULT_CALENDAR,
    median: str = "exact",
    n: int = fixed.TOP_N,
    baseline: str = fixed.BASELINE_PERIOD,
    fmt: str = "parquet",
    stage: bool = True,
    names: Names = NAMES,
) -> dict[str, dict[str, str]]:
    """Write first-tier tables, the full report and the figure tables below ``root``.

    ``stage`` first writes the clean readings, two columns, to the shared scratch folder as
    Parquet, so that the raw input is parsed once: the exact job scans them twice (rollup and
    first count, then the median's second), the approximate one once. Files are of even size,
    however many small or large ones the input has. Without it, for raw Parquet that is
    cheap to read, the raw input is scanned as often. The files
    outlive a lost executor, which a cache of the same frame does not; they are deleted once
    the first tier is written. The derived tables read the first-tier tables back from there,
    so the readings are not touched again. Returns the path of every table by group and name.
    """
    root = root.rstrip("/")
    clean = clean_readings(raw, columns, years, valid_flag, names=names)
    with scratch_folder(raw.sparkSession, "job") as work_dir:
        if stage:
            clean = written(clean.hint("rebalance"), f"{work_dir}/readings")
        readings = label_readings(clean, calendar, names)
        first = first_tier(readings, calendar, median, work_dir, names)
        tables = write_tables(first, root, fmt)

    base = load_tables(raw.sparkSession, root, fmt, names=names)
    report = full_report(base, n, baseline, names=names)
    span = range(years[0], years[1] + 1)
    figures = figure_tables(base, report, calendar, list(span), n, names)
    return {
        "tables": tables,
        "report": write_tables(report, f"{root}/report", fmt),
        "figures": write_tables(figures, f"{root}/figures", fmt),
    }
