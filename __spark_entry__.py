"""Binds the package's operators to the driver's tables, each with its SQL equivalent.

Readings at day grain come from ``orders`` (time o_orderdate, value o_totalprice, flag
o_orderstatus = 'O'); readings with hours come from ``events`` (time ts, value value, flag
event_type = 'view'). Computed doubles are rounded on both sides by the same rule, through
DECIMAL(24,8), so that the order of a distributed sum cannot show.
"""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import reduce, wraps

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from flowmetrics import NAMES, PeriodCalendar, ReadingColumns, fixed  # noqa: E402
from flowmetrics import functions as fx  # noqa: E402
from flowmetrics import operators as op  # noqa: E402
from flowmetrics.operators import charts  # noqa: E402
from flowmetrics.operators.aggregate import FINE_SKETCH_K, SKETCH_K  # noqa: E402
from flowmetrics.plans import basic_report, first_tier, full_report, run_report  # noqa: E402
from flowmetrics.schema import result_schemas  # noqa: E402
from flowmetrics.sources import (  # noqa: E402
    load_tables,
    read_delimited,
    reload_table,
    scratch_path,
    union_parts,
    write_clean_readings,
    write_table,
    write_tables,
)

# The training-data operators are a part of their own: without them the rest stands.
try:
    import corpus_pipeline  # noqa: E402
    from flowmetrics.llm import queries as llm  # noqa: E402
except ImportError:
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

LABELS = [name for name, _ in fixed.CLOSED_PERIODS]
ORDER_ENDS = ["1996-05-31", "1997-03-31", "1998-12-31", "2000-05-09"]
EVENT_ENDS = ["2024-01-07", "2024-01-14", "2024-01-21", "2024-01-26"]
ORDER_PERIODS = PeriodCalendar.of(zip(LABELS, ORDER_ENDS), fixed.OPEN_PERIOD)
EVENT_PERIODS = PeriodCalendar.of(zip(LABELS, EVENT_ENDS), fixed.OPEN_PERIOD)
# Knows only some of the labels, and none of them: for order and presence of labels.
PARTIAL_PERIODS = PeriodCalendar.of(zip(LABELS[:2], ORDER_ENDS[:2]), LABELS[3])
OTHER_PERIODS = PeriodCalendar.of([("before", ORDER_ENDS[0])], "after")

ORDER_COLUMNS = ReadingColumns("o_orderdate", "o_totalprice", "o_orderstatus")
EVENT_COLUMNS = ReadingColumns("ts", "value", "event_type")
ORDER_YEARS = (1995, 2001)
EVENT_YEARS = (2024, 2024)
YEAR_COLUMNS = list(range(ORDER_YEARS[0], ORDER_YEARS[1] + 1))

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs ---------------------------------------------------------------------------------


# Declared, so that no job is run to learn them from a file.
SCHEMAS = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
                 value double, props string""",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, labelled order readings."""
    raw = _table(spark, sf_dir, "orders")
    return op.prepare_readings(raw, ORDER_COLUMNS, ORDER_YEARS, "O", ORDER_PERIODS)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, labelled event readings."""
    raw = _table(spark, sf_dir, "events")
    return op.prepare_readings(raw, EVENT_COLUMNS, EVENT_YEARS, "view", EVENT_PERIODS)


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.monthly_mean(_orders(spark, sf_dir), ordered=False)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.daily_mean(_orders(spark, sf_dir), ordered=False)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hourly_curve(_events(spark, sf_dir), ordered=False)


def _period_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _orders(spark, sf_dir)
    return op.mean_by(readings, [NAMES.period], NAMES.value, NAMES.mean, ordered=False)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.period_summary(_orders(spark, sf_dir), median="exact", ordered=False)


def _rounded(df: DataFrame, decimals: int, *columns: str) -> DataFrame:
    return op.round_columns(df, columns, decimals)


def _day_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(NAMES.day, fx.day_text(F.col(NAMES.day)))


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be NULL, as text: checkers differ in how they read such columns."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- scans and sinks ------------------------------------------------------------------------


def _raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders written as raw readings files; a two-level glob finds them."""
    raw = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        fx.second_text(F.col("o_orderdate")).alias("fecha"),
        F.col("o_orderpriority").alias("tipo_elem"),
        F.col("o_totalprice").alias("intensidad"),
        (F.col("o_orderkey") % 100).cast("int").alias("ocupacion"),
        (F.col("o_custkey") % 100).cast("int").alias("carga"),
        (F.col("o_totalprice") / 8).alias("vmed"),
        F.col("o_orderstatus").alias("error"),
        F.lit(15).alias("periodo_integracion"),
    )
    root = scratch_path(spark, "scan")
    raw.write.option("header", True).option("sep", fixed.RAW_SEPARATOR).csv(f"{root}/files")
    return f"{root}/*/*.csv"


def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings files scanned with their declared schema."""
    return op.prune_columns(read_delimited(spark, _raw_files(spark, sf_dir)))


def scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files with the types that Spark infers from their text; times as on the clock."""
    raw = op.prune_columns(read_delimited(spark, _raw_files(spark, sf_dir), infer=True))
    return raw.withColumn("fecha", F.col("fecha").cast("timestamp_ntz"))


def reload_result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly means written as CSV part files, then reloaded as one table."""
    path = scratch_path(spark, fixed.MONTHLY_TABLE)
    write_table(op.monthly_mean(_orders(spark, sf_dir)), path, "csv")
    schema = result_schemas()[fixed.MONTHLY_TABLE]
    return _rounded(reload_table(spark, path, schema), 2, NAMES.mean)


def union_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of part files, one of them without the priority column."""
    orders = _table(spark, sf_dir, "orders")
    is_open = F.col("o_orderstatus") == "O"
    root = scratch_path(spark, "parts")
    write_table(
        orders.where(is_open).select("o_orderkey", "o_totalprice", "o_orderpriority"),
        f"{root}/open",
        "csv",
    )
    write_table(orders.where(~is_open).select("o_totalprice", "o_orderkey"), f"{root}/rest", "csv")
    key = T.StructField("o_orderkey", T.LongType())
    price = T.StructField("o_totalprice", T.DoubleType())
    priority = T.StructField("o_orderpriority", T.StringType())
    return union_parts(
        [
            reload_table(spark, f"{root}/open", T.StructType([key, price, priority])),
            reload_table(spark, f"{root}/rest", T.StructType([price, key])),
        ]
    )


def _long(name: str, df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key and measure, so that tables of several shapes can be compared at once."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key")
    rows = df.select(key, *values).unpivot("key", list(values), "measure", "result")
    return rows.select(F.lit(name).alias("table_name"), "key", "measure", "result")


REPORT_SHAPES = {
    fixed.REPORT_SUMMARY: ([NAMES.period], [NAMES.mean, NAMES.median]),
    fixed.REPORT_MONTHLY: ([NAMES.year, NAMES.month], [NAMES.mean]),
    fixed.REPORT_HOURLY: ([NAMES.period, NAMES.hour], [NAMES.mean]),
    fixed.REPORT_DAILY: ([NAMES.day], [NAMES.day_mean]),
    fixed.REPORT_ANNUAL: ([NAMES.year], [NAMES.annual_mean, NAMES.annual_change]),
    fixed.REPORT_DAY_TYPE: ([NAMES.day_type], [NAMES.mean]),
    fixed.REPORT_TOP: ([NAMES.day], [NAMES.day_mean]),
    fixed.REPORT_BOTTOM: ([NAMES.day], [NAMES.day_mean]),
    fixed.REPORT_COMPARISON: (
        [NAMES.period],
        [NAMES.mean, NAMES.median, NAMES.baseline_change],
    ),
}


def _report_rows(
    spark: SparkSession, readings: DataFrame, periods: PeriodCalendar, full: bool
) -> DataFrame:
    """Write the first tier, derive the report from it, write that, and read it all back."""
    root = scratch_path(spark, "report")
    write_tables(first_tier(readings, periods, median="exact"), root, "csv")
    base = load_tables(spark, root, "csv")
    report = full_report(base) if full else basic_report(base)
    schemas = {name: df.schema for name, df in report.items()}
    paths = write_tables(report, f"{root}/report")
    parts = [
        _long(name, reload_table(spark, path, schemas[name], "parquet"), *REPORT_SHAPES[name])
        for name, path in paths.items()
    ]
    return _rounded(reduce(DataFrame.unionByName, parts), 4, "result")


def report_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_rows(spark, _orders(spark, sf_dir), ORDER_PERIODS, full=False)


def report_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_rows(spark, _orders(spark, sf_dir), ORDER_PERIODS, full=True)


def report_full_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tables of readings with hours."""
    return _report_rows(spark, _events(spark, sf_dir), EVENT_PERIODS, full=True)


# The keys and measures of the figure tables that are not in the report's shapes.
FIGURE_SHAPES = {
    "period_bars": (["ordinal", NAMES.period], [NAMES.mean]),
    "monthly_lines": (["series", NAMES.month], [NAMES.mean]),
    "hourly_lines": (["series", NAMES.hour], [NAMES.mean]),
    "daily_series": ([NAMES.day], [NAMES.day_mean]),
    "annual_labels": ([NAMES.year, "label"], [NAMES.annual_mean, NAMES.annual_change]),
    "day_type_bars": (["ordinal", NAMES.day_type], [NAMES.mean]),
    "top_day_bars": ([NAMES.day], [NAMES.day_mean]),
    "month_year": ([NAMES.month], list(map(str, YEAR_COLUMNS))),
    "hour_period": ([NAMES.hour], ORDER_PERIODS.labels),
    "raw_month_year": ([NAMES.month], list(map(str, YEAR_COLUMNS))),
    "raw_hour_period": ([NAMES.hour], ORDER_PERIODS.labels),
    "raw_distribution": ([NAMES.period, "n"], ["q1", "median", "q3", "whisker_lo", "whisker_hi"]),
    "raw_day_type_bars": (["ordinal", NAMES.day_type], [NAMES.mean]),
    "raw_top_day_bars": ([NAMES.day], [NAMES.day_mean]),
    "raw_annual_line": ([NAMES.year, "label"], [NAMES.annual_mean]),
}
TABLE_SHAPES = {
    fixed.SUMMARY_TABLE: REPORT_SHAPES[fixed.REPORT_SUMMARY],
    fixed.MONTHLY_TABLE: REPORT_SHAPES[fixed.REPORT_MONTHLY],
    fixed.HOURLY_TABLE: REPORT_SHAPES[fixed.REPORT_HOURLY],
    fixed.DAILY_TABLE: REPORT_SHAPES[fixed.REPORT_DAILY],
}


def run_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from raw readings files: clean readings staged, first tier, report and figure
    tables written; all 28 tables read back in long form."""
    raw = op.prune_columns(read_delimited(spark, _raw_files(spark, sf_dir)))
    job = run_report(
        raw, scratch_path(spark, "job-results"), years=ORDER_YEARS, valid_flag="O", calendar=ORDER_PERIODS
    )
    shapes = {"tables": TABLE_SHAPES, "report": REPORT_SHAPES, "figures": FIGURE_SHAPES}
    parts = [
        _long(f"{group}/{name}", spark.read.parquet(path), *shapes[group][name])
        for group, paths in job.items()
        for name, path in paths.items()
    ]
    return _rounded(reduce(DataFrame.unionByName, parts), 4, "result")


# Which rows of the text readings are spoilt: by order key, what stands for time, value and flag.
SPOILT = {11: "not a date", 13: "abc", 17: "NaN", 19: "", 23: ""}


def clean_readings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning of orders written as text, some of their times, values and flags spoilt."""

    def spoilt(column: Column, *primes: int) -> Column:
        for prime in primes:
            column = F.when(F.col("o_orderkey") % prime == 0, SPOILT[prime]).otherwise(column)
        return column

    path = scratch_path(spark, "text")
    _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        spoilt(fx.second_text(F.col("o_orderdate")), 11).alias("t"),
        spoilt(F.col("o_totalprice").cast("string"), 13, 17, 19).alias("v"),
        spoilt(F.col("o_orderstatus"), 23).alias("f"),
    ).write.option("header", True).csv(path)
    text = spark.read.option("header", True).schema(
        "o_orderkey bigint, t string, v string, f string"
    ).csv(path)
    return op.clean_readings(text, ReadingColumns("t", "v", "f"), None, "O", keep=["o_orderkey"])


def filter_year_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years of clean readings staged in folders by year."""
    orders = _table(spark, sf_dir, "orders")
    clean = op.clean_readings(orders, ORDER_COLUMNS, None, "O", keep=["o_orderkey"])
    path = scratch_path(spark, "years")
    write_clean_readings(clean, path)
    return op.filter_years(spark.read.parquet(path), 1996, 1997).drop(NAMES.year)


# --- projections ----------------------------------------------------------------------------


def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    return op.prune_columns(_table(spark, sf_dir, "orders"), wanted)


def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fx.second_text(F.col("ts"))
    return _table(spark, sf_dir, "events").select(
        "event_id",
        fx.parse_timestamp(text).alias("parsed"),
        fx.parse_timestamp(F.col("event_type")).isNull().alias("other_text_is_null"),
    )


def cast_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fx.to_number(F.col("o_totalprice").cast("string")).alias("number"),
        fx.to_number(F.col("o_orderpriority")).isNull().alias("other_text_is_null"),
    )


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", F.col("ts"))
    return _day_as_text(op.add_calendar(events)).drop("ts")


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fx.day_of(F.col("o_orderdate")).alias(NAMES.day))


def classify_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.label_period(_order_days(spark, sf_dir), ORDER_PERIODS).drop(NAMES.day)


def classify_period_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.label_period_by_join(_order_days(spark, sf_dir), ORDER_PERIODS).drop(NAMES.day)


# One period per week, several hundred of them.
WEEK_ENDS = [date(1993, 1, 7) + timedelta(days=7 * i) for i in range(300)]
WEEKS = PeriodCalendar.of([(f"w{i:03d}", d) for i, d in enumerate(WEEK_ENDS)], "later")


def classify_period_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.label_period(_order_days(spark, sf_dir), WEEKS).drop(NAMES.day)


def classify_period_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _rounded(_daily(spark, sf_dir), 4, NAMES.day_mean)
    return _day_as_text(op.label_period(daily, ORDER_PERIODS))


def truncate_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", fx.truncate_day(F.col("ts")).alias("midnight"))


def parse_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day text parsed back to a day (shown as its midnight); other text gives NULL."""
    text = fx.day_text(F.col("o_orderdate"))
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fx.parse_day(text).cast("timestamp_ntz").alias("day"),
        fx.parse_day(F.col("o_orderpriority")).isNull().alias("other_text_is_null"),
    )


def weekday_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = fx.weekday_number(F.col(NAMES.day)).alias("weekday")
    return _order_days(spark, sf_dir).select("o_orderkey", number)


def day_type_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = fx.day_type(F.col(NAMES.day)).alias(NAMES.day_type)
    return _order_days(spark, sf_dir).select("o_orderkey", label)


def round_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices to one decimal; a column that is not there is ignored."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return op.round_columns(orders, ["o_totalprice", "absent"], 1)


# --- filters --------------------------------------------------------------------------------


def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return op.clean_readings(orders, ORDER_COLUMNS, None, "O", keep=["o_orderkey"])


def filter_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias(NAMES.time)
    )
    return op.filter_years(orders, 1996, 1999)


def distinct_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_periods(_orders(spark, sf_dir))


def logical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinals from a calendar that knows three of the five labels."""
    means = _period_means(spark, sf_dir)
    ordered = op.logical_order(means, PARTIAL_PERIODS)
    return _as_text(_rounded(ordered, 4, NAMES.mean), "ordinal")


def present_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = _period_means(spark, sf_dir)
    return _rounded(op.present_periods(means, PARTIAL_PERIODS), 4, NAMES.mean)


def present_periods_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No label of the calendar occurs: every row stays."""
    means = _period_means(spark, sf_dir)
    return _rounded(op.present_periods(means, OTHER_PERIODS), 4, NAMES.mean).drop("ordinal")


# --- first tier -----------------------------------------------------------------------------


def period_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = op.period_summary(_orders(spark, sf_dir), median="exact")
    return _rounded(summary, 4, NAMES.mean)


def median_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact quantile of events per period, by counting, and the mean it brings along."""
    summary = op.period_summary(_events(spark, sf_dir), "exact", ordered=False)
    return _rounded(summary, 4, NAMES.mean)


def median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketch's median is off the middle rank by at most the error it states, per period."""
    return _rank_check(spark, sf_dir, SKETCH_K, 0.001)


def _rank_check(spark: SparkSession, sf_dir: str, k: int, error: float) -> DataFrame:
    readings = _orders(spark, sf_dir)
    middle = op.period_summary(readings, "approx", k, ordered=False)
    middle = middle.select(NAMES.period, NAMES.median)
    value, median = F.col(NAMES.value), F.col(NAMES.median)
    ranks = readings.join(F.broadcast(middle), NAMES.period).groupBy(NAMES.period).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(value < median).alias("below"),
        F.count_if(value <= median).alias("upto"),
    )
    slack = F.greatest(F.lit(1.0), F.col("n") * error)
    within = (F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)
    return ranks.select(NAMES.period, "n", within.alias("within"))


def median_approx_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch as large as the reference's error asks for: off by at most n/10000 ranks."""
    return _rank_check(spark, sf_dir, FINE_SKETCH_K, 0.0001)


def monthly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.monthly_mean(_orders(spark, sf_dir)), 4, NAMES.mean)


def hourly_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.hourly_curve(_events(spark, sf_dir)), 4, NAMES.mean)


def daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = op.daily_mean(_orders(spark, sf_dir))
    return _day_as_text(_rounded(daily, 4, NAMES.day_mean))


def four_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = op.day_hour_rollup(_events(spark, sf_dir))
    grains = _rounded(op.four_grains(rollup, EVENT_PERIODS), 4, NAMES.mean)
    return _day_as_text(_as_text(grains, NAMES.year, NAMES.month, NAMES.hour))


# --- second tier ----------------------------------------------------------------------------


def annual_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.annual_mean(_monthly(spark, sf_dir)), 4, NAMES.annual_mean)


def annual_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.annual_change(_monthly(spark, sf_dir)), 4, NAMES.annual_mean)


def day_type_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.day_type_bars(op.day_type_mean(_daily(spark, sf_dir)))


def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day_as_text(op.top_days(_daily(spark, sf_dir)))


def bottom_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day_as_text(op.bottom_days(_daily(spark, sf_dir)))


def baseline_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.baseline_comparison(_summary(spark, sf_dir))


def baseline_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.baseline_comparison(_summary(spark, sf_dir), baseline="no such period")


def distribution_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = op.distribution_by_period(_daily(spark, sf_dir), ORDER_PERIODS)
    return _rounded(stats, 4, "q1", "median", "q3", "whisker_lo", "whisker_hi")


def distribution_of_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot statistics of the readings themselves, quartiles by counting."""
    stats = op.distribution_of_readings(_events(spark, sf_dir), EVENT_PERIODS)
    return _rounded(stats, 4, "q1", "median", "q3", "whisker_lo", "whisker_hi")


def event_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's change against the one before it by id: previous rows across tasks."""
    events = _table(spark, sf_dir, "events").select("event_id", "value")
    return op.change_vs_previous(events, "event_id", "value", "change_pct")


def _placed(df: DataFrame) -> DataFrame:
    """With the row's place in the result, which lies in one partition."""
    return df.withColumn("place", F.monotonically_increasing_id() + 1)


def ordered_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(op.monthly_mean(_orders(spark, sf_dir))).drop(NAMES.mean)


def ordered_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(op.hourly_curve(_events(spark, sf_dir))).drop(NAMES.mean)


def ordered_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day_as_text(_placed(op.daily_mean(_orders(spark, sf_dir)))).drop(NAMES.day_mean)


def ordered_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(op.period_summary(_events(spark, sf_dir), "exact")).drop(NAMES.mean)


def ordered_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _rounded(_monthly(spark, sf_dir), 2, NAMES.mean)
    return _placed(op.pivot_month_year(monthly, YEAR_COLUMNS)).select("place", NAMES.month)


def ordered_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = _period_means(spark, sf_dir)
    return _placed(op.logical_order(means, PARTIAL_PERIODS, [NAMES.period])).select("place", NAMES.period)


def pivot_month_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _rounded(_monthly(spark, sf_dir), 2, NAMES.mean)
    return op.pivot_month_year(monthly, YEAR_COLUMNS)


def pivot_hour_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = _rounded(_hourly(spark, sf_dir), 2, NAMES.mean)
    return op.pivot_hour_period(hourly, EVENT_PERIODS)


def day_type_mean_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.day_type_mean(_daily(spark, sf_dir), None, None), 4, NAMES.mean)


def top_days_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = op.top_days(_daily(spark, sf_dir), pre_round=None)
    return _day_as_text(_rounded(top, 4, NAMES.day_mean))


def pivot_month_year_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = op.pivot_month_year(_monthly(spark, sf_dir), YEAR_COLUMNS)
    return _rounded(wide, 4, *map(str, YEAR_COLUMNS))


def pivot_hour_period_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = op.pivot_hour_period(_hourly(spark, sf_dir), EVENT_PERIODS)
    return _rounded(wide, 4, *EVENT_PERIODS.labels)


# A first period before all orders.
EMPTY_FIRST = PeriodCalendar.of(
    [("nothing yet", "1980-01-01"), *zip(LABELS, ORDER_ENDS)], fixed.OPEN_PERIOD
)


def distribution_empty_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = op.distribution_by_period(_daily(spark, sf_dir), EMPTY_FIRST)
    return _rounded(stats, 4, "q1", "median", "q3", "whisker_lo", "whisker_hi")


# --- figure tables --------------------------------------------------------------------------


def chart_period_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = _period_means(spark, sf_dir)
    return charts.period_bars(_rounded(means, 2, NAMES.mean), ORDER_PERIODS)


def chart_monthly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.monthly_lines(_rounded(_monthly(spark, sf_dir), 2, NAMES.mean))


def chart_hourly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.hourly_lines(_rounded(_hourly(spark, sf_dir), 2, NAMES.mean))


def chart_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _rounded(_daily(spark, sf_dir), 2, NAMES.day_mean)
    return _day_as_text(charts.daily_series(daily))


def chart_annual_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual = op.annual_change(_monthly(spark, sf_dir))
    return _rounded(charts.annual_labels(annual), 4, NAMES.annual_mean)


def chart_annual_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(charts.annual_line(_monthly(spark, sf_dir)), 4, NAMES.annual_mean)


def chart_top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.top_day_bars(op.top_days(_daily(spark, sf_dir)))


# --- SQL equivalents ------------------------------------------------------------------------


def _r(x: str, decimals: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(24,8)), {decimals}) AS DOUBLE)"


def _case_period(day: str, ends: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {day} <= DATE '{e}' THEN '{n}'" for n, e in zip(LABELS, ends))
    return f"CASE {whens} ELSE '{fixed.OPEN_PERIOD}' END"


def _case_ordinal(labels: Sequence[str], column: str = NAMES.period) -> str:
    whens = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(labels, start=1))
    return f"CAST(CASE {column} {whens} END AS INTEGER)"


def _readings_sql(
    table: str, c: ReadingColumns, flag: str, years: tuple[int, int], ends: Sequence[str]
) -> str:
    return f"""
        SELECT {c.value} AS value,
               CAST(year({c.time}) AS INTEGER) AS year,
               CAST(month({c.time}) AS INTEGER) AS month,
               CAST(hour({c.time}) AS INTEGER) AS hour,
               CAST({c.time} AS DATE) AS fecha_dia,
               {_case_period(f"CAST({c.time} AS DATE)", ends)} AS periodo_covid
        FROM {table}
        WHERE {c.flag} = '{flag}' AND {c.time} IS NOT NULL
          AND {c.value} IS NOT NULL AND NOT isnan({c.value})
          AND year({c.time}) BETWEEN {years[0]} AND {years[1]}"""


_ORDERS = _readings_sql("orders", ORDER_COLUMNS, "O", ORDER_YEARS, ORDER_ENDS)
_EVENTS = _readings_sql("events", EVENT_COLUMNS, "view", EVENT_YEARS, EVENT_ENDS)
_DAY_TEXT = "strftime(fecha_dia, '%Y-%m-%d') AS fecha_dia"


def _means(readings: str, keys: str, alias: str = "intensidad_media") -> str:
    return f"SELECT {keys}, avg(value) AS {alias} FROM ({readings}) GROUP BY {keys}"


def _summary_sql(readings: str) -> str:
    return f"""
    SELECT periodo_covid, avg(value) AS intensidad_media,
           quantile_disc(value, 0.5) AS intensidad_mediana
    FROM ({readings}) GROUP BY periodo_covid"""


def _daily_2_sql(daily: str) -> str:
    rounded = _r("intensidad_media_dia", 2)
    return f"SELECT fecha_dia, {rounded} AS intensidad_media_dia FROM ({daily})"


def _annual_change_sql(monthly: str) -> str:
    annual = f"""
    SELECT year, avg({_r("intensidad_media", 2)}) AS intensidad_media_anual
    FROM ({monthly}) GROUP BY year"""
    change = """(intensidad_media_anual
                   / nullif(lag(intensidad_media_anual) OVER (ORDER BY year), 0) - 1) * 100"""
    return f"""
    SELECT year, {_r("intensidad_media_anual", 4)} AS intensidad_media_anual,
           {_r(change, 2)} AS variacion_pct_vs_anio_anterior
    FROM ({annual})"""


_MONTHLY = _means(_ORDERS, "year, month")
_DAILY = _means(_ORDERS, "fecha_dia", "intensidad_media_dia")
_HOURLY = _means(_EVENTS, "periodo_covid, hour")
_PERIOD_MEANS = _means(_ORDERS, "periodo_covid")
_SUMMARY = _summary_sql(_ORDERS)
_DAILY_2 = _daily_2_sql(_DAILY)
_ANNUAL = f"""
    SELECT year, avg({_r("intensidad_media", 2)}) AS intensidad_media_anual
    FROM ({_MONTHLY}) GROUP BY year"""
_ANNUAL_CHANGE = _annual_change_sql(_MONTHLY)
_DAY_TYPE = """
    CASE WHEN isodow({day}) < 6 THEN 'Laborable' WHEN isodow({day}) = 6 THEN 'Sábado'
         ELSE 'Domingo' END"""


def _day_type_sql(daily: str, decimals: int) -> str:
    return f"""
    SELECT tipo_dia, {_r("avg(intensidad_media_dia)", decimals)} AS intensidad_media
    FROM (SELECT {_DAY_TYPE.format(day="fecha_dia")} AS tipo_dia, intensidad_media_dia
          FROM ({daily})) GROUP BY tipo_dia"""


def _ranked_sql(daily: str, direction: str = "") -> str:
    return f"""
    SELECT {_DAY_TEXT}, intensidad_media_dia
    FROM (SELECT * FROM ({daily}) ORDER BY intensidad_media_dia {direction}, fecha_dia LIMIT 10)"""


_DAY_TYPE_MEAN = _day_type_sql(_DAILY_2, 2)
_TOP = _ranked_sql(_DAILY_2, "DESC")
_BOTTOM = _ranked_sql(_DAILY_2)


def _comparison(baseline: str, summary: str = _SUMMARY) -> str:
    return f"""
        WITH s AS (SELECT periodo_covid, {_r("intensidad_media", 2)} AS intensidad_media,
                          {_r("intensidad_mediana", 2)} AS intensidad_mediana FROM ({summary})),
             b AS (SELECT max(intensidad_media) AS base FROM s WHERE periodo_covid = '{baseline}')
        SELECT periodo_covid, intensidad_media, intensidad_mediana,
               {_r("(intensidad_media - base) / nullif(base, 0) * 100", 2)}
                 AS "variacion_vs_PreCOVID_pct"
        FROM s, b"""


def _long_sql(name: str, source: str, key: str, measures: Sequence[tuple[str, str]]) -> list[str]:
    return [
        f"SELECT '{name}' AS table_name, {key} AS key, '{m}' AS measure, {x} AS result "
        f"FROM ({source})"
        for m, x in measures
    ]


def _report_sql(full: bool, readings: str = _ORDERS) -> str:
    mean2 = (NAMES.mean, _r("intensidad_media", 2))
    median2 = (NAMES.median, _r("intensidad_mediana", 2))
    summary, monthly = _summary_sql(readings), _means(readings, "year, month")
    hourly = _means(readings, "periodo_covid, hour")
    daily = _daily_2_sql(_means(readings, "fecha_dia", "intensidad_media_dia"))
    parts = [
        *_long_sql(fixed.REPORT_SUMMARY, summary, "periodo_covid", [mean2, median2]),
        *_long_sql(fixed.REPORT_MONTHLY, monthly, "concat_ws('|', year, month)", [mean2]),
        *_long_sql(fixed.REPORT_HOURLY, hourly, "concat_ws('|', periodo_covid, hour)", [mean2]),
        *_long_sql(
            fixed.REPORT_DAILY,
            daily,
            "strftime(fecha_dia, '%Y-%m-%d')",
            [(NAMES.day_mean, NAMES.day_mean)],
        ),
    ]
    if full:
        parts += [
            *_long_sql(
                fixed.REPORT_ANNUAL,
                _annual_change_sql(monthly),
                "CAST(year AS VARCHAR)",
                [(c, c) for c in (NAMES.annual_mean, NAMES.annual_change)],
            ),
            *_long_sql(
                fixed.REPORT_DAY_TYPE, _day_type_sql(daily, 2), "tipo_dia", [(NAMES.mean, NAMES.mean)]
            ),
            *_long_sql(fixed.REPORT_TOP, _ranked_sql(daily, "DESC"), "fecha_dia", [(NAMES.day_mean, NAMES.day_mean)]),
            *_long_sql(
                fixed.REPORT_BOTTOM, _ranked_sql(daily), "fecha_dia", [(NAMES.day_mean, NAMES.day_mean)]
            ),
            *_long_sql(
                fixed.REPORT_COMPARISON,
                _comparison(fixed.BASELINE_PERIOD, summary),
                "periodo_covid",
                [
                    (NAMES.mean, NAMES.mean),
                    (NAMES.median, NAMES.median),
                    (NAMES.baseline_change, f'"{NAMES.baseline_change}"'),
                ],
            ),
        ]
    return " UNION ALL ".join(parts)


def _matrix_sql(
    source: str, row: str, column: str, values: Sequence, decimals: int = 2
) -> str:
    mean = _r("intensidad_media", decimals)
    cells = ", ".join(
        f"max(CASE WHEN {column} = {v!r} THEN {mean} END) AS \"{v}\""
        for v in values
    )
    return f"SELECT {row}, {cells} FROM ({source}) GROUP BY {row}"


_DAILY_VALUES = f"""
    SELECT {_case_period("fecha_dia", ORDER_ENDS)} AS periodo_covid, intensidad_media_dia AS v
    FROM ({_DAILY})"""


def _distribution_sql(periods: PeriodCalendar = ORDER_PERIODS, values: str = _DAILY_VALUES) -> str:
    labels = ", ".join(f"('{n}')" for n in periods.labels)
    lo = "min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END)"
    hi = "max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END)"
    return f"""
        WITH d AS ({values}),
             b AS (SELECT periodo_covid, quantile_cont(v, 0.25) AS q1,
                          quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3,
                          count(*) AS n FROM d GROUP BY periodo_covid),
             w AS (SELECT periodo_covid, q1, median, q3, n,
                          least({lo}, q1) AS whisker_lo, greatest({hi}, q3) AS whisker_hi
                   FROM d JOIN b USING (periodo_covid)
                   GROUP BY periodo_covid, q1, median, q3, n)
        SELECT p.periodo_covid, {_r("q1", 4)} AS q1, {_r("median", 4)} AS median,
               {_r("q3", 4)} AS q3, {_r("whisker_lo", 4)} AS whisker_lo,
               {_r("whisker_hi", 4)} AS whisker_hi, CAST(coalesce(n, 0) AS BIGINT) AS n
        FROM (VALUES {labels}) AS p(periodo_covid) LEFT JOIN w USING (periodo_covid)"""


def _job_sql() -> str:
    """All 28 tables of the job in long form."""

    def rows(name: str, source: str, key: str, *measures: tuple[str, str]) -> list[str]:
        return _long_sql(name, source, key, [(m, _r(x, 4)) for m, x in measures])

    mean, median = (NAMES.mean, NAMES.mean), (NAMES.median, NAMES.median)
    mean2 = (NAMES.mean, _r(NAMES.mean, 2))
    day_mean = (NAMES.day_mean, NAMES.day_mean)
    year_month, period_hour = "concat_ws('|', year, month)", "concat_ws('|', periodo_covid, hour)"
    day, day2 = "strftime(fecha_dia, '%Y-%m-%d')", "fecha_dia"
    ordinal = _case_ordinal(ORDER_PERIODS.labels)
    kind = f"concat_ws('|', {_case_ordinal(fixed.DAY_TYPES, 'tipo_dia')}, tipo_dia)"
    hourly = _means(_ORDERS, "periodo_covid, hour")
    years = [(str(y), f'"{y}"') for y in YEAR_COLUMNS]
    periods = [(p, f'"{p}"') for p in ORDER_PERIODS.labels]
    box = [(c, c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")]
    signed = f"""concat_ws('|', year, format('{{:+.1f}}%', {NAMES.annual_change}))"""
    whole = f"""concat_ws('|', year, format('{{:.0f}}', {NAMES.annual_mean}))"""
    annual_raw = f"""
        SELECT year, avg(intensidad_media) AS {NAMES.annual_mean} FROM ({_MONTHLY}) GROUP BY year"""
    parts = [
        *rows(f"tables/{fixed.SUMMARY_TABLE}", _SUMMARY, "periodo_covid", mean, median),
        *rows(f"tables/{fixed.MONTHLY_TABLE}", _MONTHLY, year_month, mean),
        *rows(f"tables/{fixed.HOURLY_TABLE}", hourly, period_hour, mean),
        *rows(f"tables/{fixed.DAILY_TABLE}", _DAILY, day, day_mean),
        *rows("figures/period_bars", _SUMMARY, f"concat_ws('|', {ordinal}, periodo_covid)", mean2),
        *rows("figures/monthly_lines", _MONTHLY, year_month, mean2),
        *rows("figures/hourly_lines", hourly, period_hour, mean2),
        *rows("figures/daily_series", _DAILY_2, day, day_mean),
        *rows("figures/annual_labels", _ANNUAL_CHANGE, signed,
              *[(c, c) for c in (NAMES.annual_mean, NAMES.annual_change)]),
        *rows("figures/day_type_bars", _DAY_TYPE_MEAN, kind, mean),
        *rows("figures/top_day_bars", _TOP, day2, day_mean),
        *rows("figures/month_year", _matrix_sql(_MONTHLY, "month", "year", YEAR_COLUMNS),
              "CAST(month AS VARCHAR)", *years),
        *rows("figures/hour_period", _matrix_sql(hourly, "hour", "periodo_covid", ORDER_PERIODS.labels),
              "CAST(hour AS VARCHAR)", *periods),
        *rows("figures/raw_month_year", _matrix_sql(_MONTHLY, "month", "year", YEAR_COLUMNS, 4),
              "CAST(month AS VARCHAR)", *years),
        *rows("figures/raw_hour_period",
              _matrix_sql(hourly, "hour", "periodo_covid", ORDER_PERIODS.labels, 4),
              "CAST(hour AS VARCHAR)", *periods),
        *rows("figures/raw_distribution", _distribution_sql(), "concat_ws('|', periodo_covid, n)", *box),
        *rows("figures/raw_day_type_bars", _day_type_sql(_DAILY, 4), kind, mean),
        *rows("figures/raw_top_day_bars", _ranked_sql(_DAILY, "DESC"), day2, day_mean),
        *rows("figures/raw_annual_line", annual_raw, whole, (NAMES.annual_mean, NAMES.annual_mean)),
    ]
    report = f"SELECT 'report/' || table_name AS table_name, key, measure, result FROM ({_report_sql(True)})"
    return " UNION ALL ".join([*parts, report])


def _place_sql(source: str, order: str, *columns: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS place, {', '.join(columns)} FROM ({source})"


def _queries_sql() -> dict[str, str]:
    order_day = "CAST(o_orderdate AS DATE)"
    mean4 = f"{_r('intensidad_media', 4)} AS intensidad_media"
    mean2 = f"{_r('intensidad_media', 2)} AS intensidad_media"
    partial = _case_ordinal(PARTIAL_PERIODS.labels)
    classified = f"""SELECT o_orderkey, {_case_period(order_day, ORDER_ENDS)} AS periodo_covid
                     FROM orders"""
    return {
        "scan_delimited": """
            SELECT o_custkey AS id, date_trunc('second', o_orderdate) AS fecha,
                   o_orderpriority AS tipo_elem, o_totalprice AS intensidad,
                   CAST(o_orderkey % 100 AS INTEGER) AS ocupacion,
                   CAST(o_custkey % 100 AS INTEGER) AS carga, o_totalprice / 8 AS vmed,
                   o_orderstatus AS error, CAST(15 AS INTEGER) AS periodo_integracion
            FROM orders""",
        "reload_result_table": f"SELECT year, month, {mean2} FROM ({_MONTHLY})",
        "union_parts": """
            SELECT o_orderkey, o_totalprice,
                   CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority
            FROM orders""",
        "report_basic": _report_sql(full=False),
        "report_full": _report_sql(full=True),
        "prune_columns": "SELECT o_custkey, o_orderdate, o_totalprice, o_orderstatus FROM orders",
        "parse_timestamp": """
            SELECT event_id, date_trunc('second', ts) AS parsed,
                   TRY_CAST(event_type AS TIMESTAMP) IS NULL AS other_text_is_null
            FROM events""",
        "cast_value": """
            SELECT o_orderkey, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS number,
                   TRY_CAST(o_orderpriority AS DOUBLE) IS NULL AS other_text_is_null
            FROM orders""",
        "calendar_parts": """
            SELECT event_id, CAST(year(ts) AS INTEGER) AS year,
                   CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
                   strftime(ts, '%Y-%m-%d') AS fecha_dia FROM events""",
        "classify_period": classified,
        "classify_period_join": classified,
        "classify_period_daily": f"""
            SELECT {_DAY_TEXT}, {_r("intensidad_media_dia", 4)} AS intensidad_media_dia,
                   {_case_period("fecha_dia", ORDER_ENDS)} AS periodo_covid FROM ({_DAILY})""",
        "truncate_day": """
            SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS midnight FROM events""",
        "parse_day": """
            SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day,
                   TRY_CAST(o_orderpriority AS DATE) IS NULL AS other_text_is_null
            FROM orders""",
        "weekday_number": """
            SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday FROM orders""",
        "day_type_label": f"""
            SELECT o_orderkey, {_DAY_TYPE.format(day="o_orderdate")} AS tipo_dia FROM orders""",
        "round_columns": f"""
            SELECT o_orderkey, {_r("o_totalprice", 1)} AS o_totalprice FROM orders""",
        "clean_readings": """
            SELECT o_orderkey, o_orderdate AS ts, o_totalprice AS value FROM orders
            WHERE o_orderstatus = 'O' AND o_orderdate IS NOT NULL
              AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)""",
        "filter_year_range": """
            SELECT o_orderkey, o_orderdate AS ts FROM orders
            WHERE year(o_orderdate) BETWEEN 1996 AND 1999""",
        "distinct_periods": f"SELECT DISTINCT periodo_covid FROM ({_ORDERS})",
        "logical_order": f"""
            SELECT periodo_covid, {mean4}, CAST({partial} AS VARCHAR) AS ordinal
            FROM ({_PERIOD_MEANS})""",
        "present_periods": f"""
            SELECT periodo_covid, {mean4}, {partial} AS ordinal FROM ({_PERIOD_MEANS})
            WHERE {partial} IS NOT NULL""",
        "present_periods_fallback": f"""
            SELECT periodo_covid, {mean4} FROM ({_PERIOD_MEANS})""",
        "period_summary": f"SELECT periodo_covid, {mean4}, intensidad_mediana FROM ({_SUMMARY})",
        "median_exact": f"""
            SELECT periodo_covid, {mean4}, quantile_disc(value, 0.5) AS intensidad_mediana
            FROM (SELECT periodo_covid, avg(value) AS intensidad_media, list(value) AS vs
                  FROM ({_EVENTS}) GROUP BY periodo_covid), unnest(vs) AS t(value)
            GROUP BY periodo_covid, intensidad_media""",
        "median_approx": f"""
            SELECT periodo_covid, count(*) AS n, true AS within
            FROM ({_ORDERS}) GROUP BY periodo_covid""",
        "median_approx_fine": f"""
            SELECT periodo_covid, count(*) AS n, true AS within
            FROM ({_ORDERS}) GROUP BY periodo_covid""",
        "scan_inferred": """
            SELECT CAST(o_custkey AS INTEGER) AS id, date_trunc('second', o_orderdate) AS fecha,
                   o_orderpriority AS tipo_elem, o_totalprice AS intensidad,
                   CAST(o_orderkey % 100 AS INTEGER) AS ocupacion,
                   CAST(o_custkey % 100 AS INTEGER) AS carga, o_totalprice / 8 AS vmed,
                   o_orderstatus AS error, CAST(15 AS INTEGER) AS periodo_integracion
            FROM orders""",
        "run_job": _job_sql(),
        "distribution_of_readings": _distribution_sql(
            EVENT_PERIODS, f"SELECT periodo_covid, value AS v FROM ({_EVENTS})"
        ),
        "event_change": f"""
            SELECT event_id, value,
                   {_r("(value - previous) / nullif(previous, 0) * 100", 2)} AS change_pct
            FROM (SELECT event_id, value, lag(value) OVER (ORDER BY event_id) AS previous FROM events)""",
        "ordered_summary": _place_sql(
            _summary_sql(_EVENTS), "periodo_covid", "periodo_covid", "intensidad_mediana"
        ),
        "ordered_monthly": _place_sql(_MONTHLY, "year, month", "year", "month"),
        "ordered_hourly": _place_sql(_HOURLY, "periodo_covid, hour", "periodo_covid", "hour"),
        "ordered_daily": _place_sql(_DAILY, "fecha_dia", _DAY_TEXT),
        "ordered_matrix": _place_sql(f"SELECT DISTINCT month FROM ({_MONTHLY})", "month", "month"),
        "ordered_periods": _place_sql(
            _PERIOD_MEANS, f"{partial} NULLS LAST, periodo_covid", "periodo_covid"
        ),
        "monthly_mean": f"SELECT year, month, {mean4} FROM ({_MONTHLY})",
        "hourly_curve": f"SELECT periodo_covid, hour, {mean4} FROM ({_HOURLY})",
        "daily_mean": f"""
            SELECT {_DAY_TEXT}, {_r("intensidad_media_dia", 4)} AS intensidad_media_dia
            FROM ({_DAILY})""",
        "four_grains": f"""
            SELECT periodo_covid, CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month,
                   CAST(hour AS VARCHAR) AS hour, {_DAY_TEXT}, grain_id, {mean4}, n
            FROM (SELECT periodo_covid, year, month, hour, fecha_dia,
                         CAST(GROUPING(periodo_covid, year, month, hour, fecha_dia) AS BIGINT)
                           AS grain_id,
                         avg(value) AS intensidad_media, count(value) AS n
                  FROM ({_EVENTS})
                  GROUP BY GROUPING SETS ((periodo_covid), (year, month),
                                          (periodo_covid, hour), (fecha_dia)))""",
        "annual_mean": f"""
            SELECT year, {_r("intensidad_media_anual", 4)} AS intensidad_media_anual
            FROM ({_ANNUAL})""",
        "annual_change": _ANNUAL_CHANGE,
        "day_type_mean": f"""
            SELECT {_case_ordinal(fixed.DAY_TYPES, "tipo_dia")} AS ordinal, tipo_dia,
                   intensidad_media FROM ({_DAY_TYPE_MEAN})""",
        "top_days": _TOP,
        "bottom_days": _BOTTOM,
        "baseline_comparison": _comparison(fixed.BASELINE_PERIOD),
        "baseline_missing": _comparison("no such period"),
        "distribution_by_period": _distribution_sql(),
        "day_type_mean_raw": _day_type_sql(_DAILY, 4),
        "top_days_raw": f"""
            SELECT fecha_dia, {_r("intensidad_media_dia", 4)} AS intensidad_media_dia
            FROM ({_ranked_sql(_DAILY, "DESC")})""",
        "pivot_month_year_raw": _matrix_sql(_MONTHLY, "month", "year", YEAR_COLUMNS, 4),
        "pivot_hour_period_raw": _matrix_sql(
            _HOURLY, "hour", "periodo_covid", EVENT_PERIODS.labels, 4
        ),
        "distribution_empty_period": _distribution_sql(EMPTY_FIRST),
        "report_full_events": _report_sql(True, _EVENTS),
        "classify_period_long": f"""
            SELECT o_orderkey, CASE WHEN d <= 0 THEN 'w000' WHEN d > {7 * (len(WEEK_ENDS) - 1)}
                   THEN 'later' ELSE 'w' || lpad(CAST((d + 6) // 7 AS VARCHAR), 3, '0')
                   END AS periodo_covid
            FROM (SELECT o_orderkey, {order_day} - DATE '{WEEK_ENDS[0]}' AS d FROM orders)""",
        "clean_readings_text": """
            SELECT o_orderkey, date_trunc('second', o_orderdate) AS ts, o_totalprice AS value
            FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
              AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0""",
        "filter_year_partitions": """
            SELECT o_orderkey, o_orderdate AS ts, o_totalprice AS value FROM orders
            WHERE o_orderstatus = 'O' AND year(o_orderdate) BETWEEN 1996 AND 1997""",
        "pivot_month_year": _matrix_sql(_MONTHLY, "month", "year", YEAR_COLUMNS),
        "pivot_hour_period": _matrix_sql(_HOURLY, "hour", "periodo_covid", EVENT_PERIODS.labels),
        "chart_period_bars": f"""
            SELECT {_case_ordinal(ORDER_PERIODS.labels)} AS ordinal, periodo_covid, {mean2},
                   format('{{:.0f}}', {_r("intensidad_media", 2)}) AS label
            FROM ({_PERIOD_MEANS})""",
        "chart_monthly_lines": f"""
            SELECT CAST(year AS VARCHAR) AS series, month, {mean2} FROM ({_MONTHLY})""",
        "chart_hourly_lines": f"SELECT periodo_covid AS series, hour, {mean2} FROM ({_HOURLY})",
        "chart_daily_series": f"SELECT {_DAY_TEXT}, intensidad_media_dia FROM ({_DAILY_2})",
        "chart_annual_labels": f"""
            SELECT year, intensidad_media_anual, variacion_pct_vs_anio_anterior,
                   format('{{:+.1f}}%', variacion_pct_vs_anio_anterior) AS label
            FROM ({_ANNUAL_CHANGE})""",
        "chart_annual_line": f"""
            SELECT year, {_r("avg(intensidad_media)", 4)} AS intensidad_media_anual,
                   format('{{:.0f}}', avg(intensidad_media)) AS label
            FROM ({_MONTHLY}) GROUP BY year""",
        "chart_top_days": _TOP,
    }


# --- driver contract ------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: mean and median value per named period."""
    return period_summary(spark, SMOKE_DIR)


def own_queries() -> dict[str, Query]:
    """The queries of this package's own operators."""
    return {
        "scan_delimited": scan_delimited,
        "reload_result_table": reload_result_table,
        "union_parts": union_of_parts,
        "report_basic": report_basic,
        "report_full": report_full,
        "report_full_events": report_full_events,
        "clean_readings_text": clean_readings_text,
        "filter_year_partitions": filter_year_partitions,
        "classify_period_long": classify_period_long,
        "day_type_mean_raw": day_type_mean_raw,
        "top_days_raw": top_days_raw,
        "pivot_month_year_raw": pivot_month_year_raw,
        "pivot_hour_period_raw": pivot_hour_period_raw,
        "distribution_empty_period": distribution_empty_period,
        "prune_columns": prune_columns,
        "parse_timestamp": parse_timestamp,
        "cast_value": cast_value,
        "calendar_parts": calendar_parts,
        "classify_period": classify_period,
        "classify_period_join": classify_period_join,
        "classify_period_daily": classify_period_daily,
        "truncate_day": truncate_day,
        "parse_day": parse_day,
        "weekday_number": weekday_number,
        "day_type_label": day_type_label,
        "round_columns": round_columns,
        "clean_readings": clean_readings,
        "filter_year_range": filter_year_range,
        "distinct_periods": distinct_periods,
        "logical_order": logical_order,
        "present_periods": present_periods,
        "present_periods_fallback": present_periods_fallback,
        "period_summary": period_summary,
        "median_exact": median_exact,
        "median_approx": median_approx,
        "median_approx_fine": median_approx_fine,
        "scan_inferred": scan_inferred,
        "run_job": run_job,
        "distribution_of_readings": distribution_of_readings,
        "event_change": event_change,
        "ordered_summary": ordered_summary,
        "ordered_monthly": ordered_monthly,
        "ordered_hourly": ordered_hourly,
        "ordered_daily": ordered_daily,
        "ordered_matrix": ordered_matrix,
        "ordered_periods": ordered_periods,
        "monthly_mean": monthly_mean,
        "hourly_curve": hourly_curve,
        "daily_mean": daily_mean,
        "four_grains": four_grains,
        "annual_mean": annual_mean,
        "annual_change": annual_change,
        "day_type_mean": day_type_mean,
        "top_days": top_days,
        "bottom_days": bottom_days,
        "baseline_comparison": baseline_comparison,
        "baseline_missing": baseline_missing,
        "distribution_by_period": distribution_by_period,
        "pivot_month_year": pivot_month_year,
        "pivot_hour_period": pivot_hour_period,
        "chart_period_bars": chart_period_bars,
        "chart_monthly_lines": chart_monthly_lines,
        "chart_hourly_lines": chart_hourly_lines,
        "chart_daily_series": chart_daily_series,
        "chart_annual_labels": chart_annual_labels,
        "chart_annual_line": chart_annual_line,
        "chart_top_days": chart_top_days,
    }


def _ready(query: Query) -> Query:
    """The query in a session with a folder for scratch tables.

    A cluster names its shared folder in ``spark.checkpoint.dir``; a local session without one
    gets a temporary folder, which all of its one machine can reach.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local["):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    every = own_queries()
    if llm is not None:
        every |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return {name: _ready(query) for name, query in every.items()}


def oracle_sql() -> dict[str, str]:
    """The SQL equivalent of each query that SQL can express."""
    sql = _queries_sql()
    if llm is not None:
        sql |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
