"""Change against the previous year and against a baseline period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowmetrics import fixed
from flowmetrics.functions.numbers import pct_change, round_stable
from flowmetrics.names import NAMES, Names
from flowmetrics.operators.aggregate import annual_mean
from flowmetrics.operators.order import sorted_small
from flowmetrics.sources.scratch import scratch_path, written


def _change(
    df: DataFrame, rows: W, order: str, value: str, carried: tuple[Column, Column, Column] | None,
    alias: str, decimals: int,
) -> DataFrame:
    """The change against the row before, where ``carried`` says whether there is one before the
    first row, its order and its value."""
    ordered = rows.orderBy(F.asc_nulls_first(order))
    seen = F.lag(F.lit(True)).over(ordered)
    before, previous = F.lag(order).over(ordered), F.lag(value).over(ordered)
    if carried is not None:
        has, last_order, last_value = carried
        before = F.when(seen, before).otherwise(last_order)
        previous = F.when(seen, previous).otherwise(last_value)
        seen = F.coalesce(seen, has)
    # The neighbours in order tell whether an order has a second row.
    twin = F.coalesce(seen, F.lit(False)) & F.col(order).eqNullSafe(before)
    error = F.raise_error(F.lit("change_vs_previous: more than one row per order"))
    change = round_stable(pct_change(F.col(value), previous), decimals)
    return df.withColumn(alias, F.when(twin, error).otherwise(change))


def change_vs_previous(
    df: DataFrame,
    order: str,
    value: str,
    alias: str,
    decimals: int = fixed.DECIMALS,
    partition_by: Sequence[str] = (),
    small: bool = False,
) -> DataFrame:
    """Add the percent change against the previous row in ``order``, within ``partition_by``.

    The previous row is meant, not the previous year: a gap is bridged. NULL for the first
    row and after a value of 0; a NULL ``order`` comes first. Two rows of one ``order`` are an error.

    Without ``partition_by`` the rows are range-partitioned by ``order`` and written, each range is
    looked at by itself, and its first row is handed the last one of the range before; the driver
    sees one row per range. ``small`` says that the table fits one task, as one row per year does,
    and saves these jobs.
    """
    if partition_by or small:
        return _change(df, W.partitionBy(*partition_by), order, value, None, alias, decimals)
    spark = df.sparkSession
    part = "_range"
    rows = df.repartitionByRange(F.asc_nulls_first(order)).withColumn(part, F.spark_partition_id())
    rows = written(rows, scratch_path(spark, "ordered"))
    # NULL orders count as the least, so the flag in front decides first.
    last = F.max(F.struct(F.col(order).isNotNull(), order, value)).alias("last")
    ends = rows.groupBy(part).agg(last).select(
        part, F.col("last")[order].alias("_order"), F.col("last")[value].alias("_value")
    )
    ends = ends.orderBy(part).toArrow()
    handed = ends.slice(0, max(0, len(ends) - 1)).set_column(0, part, ends.slice(1).column(part))
    lasts = spark.createDataFrame(handed).withColumn("_has", F.lit(True))
    joined = rows.join(F.broadcast(lasts), part, "left")  # one row per range, just collected
    carried = (F.col("_has"), F.col("_order"), F.col("_value"))
    return _change(joined, W.partitionBy(part), order, value, carried, alias, decimals).select(
        *[c for c in df.columns if c != alias], alias
    )


def annual_change(
    monthly: DataFrame, pre_round: int | None = fixed.DECIMALS, names: Names = NAMES
) -> DataFrame:
    """Annual mean and its percent change against the year before in the table."""
    annual = annual_mean(monthly, pre_round, ordered=False, names=names)
    changed = change_vs_previous(
        annual, names.year, names.annual_mean, names.annual_change, small=True
    )
    return changed.sortWithinPartitions(names.year)  # the window left them in one


def baseline_comparison(
    summary: DataFrame,
    baseline: str = fixed.BASELINE_PERIOD,
    decimals: int = fixed.DECIMALS,
    pre_round: int | None = fixed.DECIMALS,
    names: Names = NAMES,
) -> DataFrame:
    """Add each period's percent change against the baseline period.

    NULL throughout when the baseline is absent or 0. The summary, one row per period, is written
    first, so that what lies below it runs once; the baseline is a scalar of the written rows.
    """
    if pre_round is not None:
        rounded = {
            c: round_stable(F.col(c), pre_round)
            for c in (names.mean, names.median)
            if c in summary.columns
        }
        summary = summary.withColumns(rounded)
    summary = written(summary, scratch_path(summary.sparkSession, "summary"))
    base = summary.where(F.col(names.period) == baseline).agg(F.max(names.mean)).scalar()
    change = round_stable(pct_change(F.col(names.mean), base), decimals)
    return sorted_small(summary.withColumn(names.baseline_change, change), names.period)
