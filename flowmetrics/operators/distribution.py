"""Box-plot statistics per period, of daily means and of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmetrics.functions.periods import DEFAULT_CALENDAR, PeriodCalendar
from flowmetrics.names import NAMES, Names
from flowmetrics.operators.median import interpolated_quantiles
from flowmetrics.operators.order import sorted_small

WHISKER_REACH = 1.5
QUARTILES = (0.25, 0.5, 0.75)
COLUMNS = ["q1", "median", "q3", "whisker_lo", "whisker_hi", "n"]


def _whiskers(value: str) -> list[Column]:
    """The furthest values within reach of the box; its own ends where there are none."""
    reach = f"(q3 - q1) * {WHISKER_REACH}D"
    lowest = f"min(CASE WHEN {value} >= q1 - {reach} THEN {value} END)"
    highest = f"max(CASE WHEN {value} <= q3 + {reach} THEN {value} END)"
    return [
        F.expr(f"least({lowest}, q1) AS whisker_lo"),
        F.expr(f"greatest({highest}, q3) AS whisker_hi"),
    ]


def _every_period(
    df: DataFrame, calendar: PeriodCalendar, names: Names, *columns: Column
) -> DataFrame:
    """One row per period of the calendar with these columns beside the label."""
    return calendar.frame(df.sparkSession, names.period).select(names.period, *columns)


def _in_order(boxes: DataFrame, calendar: PeriodCalendar, names: Names) -> DataFrame:
    return sorted_small(boxes.select(names.period, *COLUMNS), calendar.ordinal_of(names.period))


def distribution_by_period(
    daily: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """Quartiles (linear interpolation), whiskers and day count per period, in time order.

    A whisker ends at the furthest day within 1.5 interquartile ranges of the box, and at the
    box when there is none. A period without days has n = 0 and NULL statistics. The input
    holds one row per day, so a group is never larger than the days of its period; values are
    found by their place in order, and rows that do not fit memory spill. See
    :func:`distribution_of_readings` for tables of any size.
    """
    # Rows without a value are not counted; one stands for each period, so that none is missing.
    days = daily.select(calendar.label(f"`{names.day}`").alias("p"), F.col(names.day_mean).alias("v"))
    none = _every_period(daily, calendar, names, F.expr("CAST(NULL AS double)"))
    rows = days.union(none)
    own = "OVER (PARTITION BY p)"
    placed = rows.selectExpr(
        "*", "row_number() OVER (PARTITION BY p ORDER BY v NULLS LAST) - 1 AS at", f"count(v) {own} AS n"
    )
    quartiles = []
    for p, name in zip(QUARTILES, COLUMNS):
        place = f"(n - 1) * {p}D"
        low, high = (f"max(CASE WHEN at = {f}({place}) THEN v END) {own}" for f in ("floor", "ceil"))
        quartiles.append(f"{low} + ({place} - floor({place})) * ({high} - {low}) AS {name}")
    boxes = placed.selectExpr("p", "v", "n", *quartiles).groupBy("p", "n", *COLUMNS[:3]).agg(
        *_whiskers("v")
    )
    return _in_order(boxes.withColumnRenamed("p", names.period), calendar, names)


def distribution_of_readings(
    readings: DataFrame, calendar: PeriodCalendar = DEFAULT_CALENDAR, names: Names = NAMES
) -> DataFrame:
    """The statistics of :func:`distribution_by_period` over the labelled readings themselves.

    Quartiles are found by counting (see :func:`~flowmetrics.operators.median.order_statistics`), all
    of them in the same rounds; whiskers are minima and maxima of one more scan, which meets one
    row per period. No task holds a period. Readings of labels that are not in the calendar are
    left out; NULL values are skipped.
    """
    known = readings.where(calendar.ordinal_of(names.period).isNotNull())
    known = known.select(names.period, names.value)
    found = interpolated_quantiles(known, names.period, names.value, QUARTILES)
    boxes = found.where("rows > 0").select(
        F.col("g").alias("box"), F.col("rows").alias("n"),
        *[F.col("q")[i].alias(q) for i, q in enumerate(["q1", "median", "q3"])],
    )
    # One row per period of the calendar.
    met = known.join(F.broadcast(boxes), F.col(names.period) == F.col("box"))
    spread = met.groupBy(names.period, "n", "q1", "median", "q3").agg(*_whiskers(f"`{names.value}`"))
    none = _every_period(
        readings, calendar, names, F.lit(0).cast("bigint").alias("n"),
        *[F.lit(None).cast("double").alias(c) for c in COLUMNS[:-1]],
    )
    both = spread.unionByName(none)
    whole = both.groupBy(names.period).agg(*[F.max(c).alias(c) for c in COLUMNS])
    return _in_order(whole, calendar, names)
