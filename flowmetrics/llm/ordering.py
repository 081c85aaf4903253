"""Global ranks without a global sort in one task, from DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmetrics.sources.scratch import scratch_path, written


def ranked_in_buckets(
    rows: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[Column], rank: str,
    size: str,
) -> DataFrame:
    """Add the 0-based rank of each row in its group, and the group's size.

    ``bucket`` must rise with ``order`` within a group and hold a bounded number of rows: a
    bucket is ranked in one task, a group is not. Buckets are counted and their running sums
    joined back, so a group with most of the rows is spread over as many tasks as it has buckets.
    Group columns must not be NULL. ``rows`` is read twice: pass a written table.
    """
    keys = [*groups, bucket]
    local = Window.partitionBy(*keys).orderBy(*order)
    # A constant partition keeps Spark from warning about a window without one; this one sees
    # a row per bucket.
    within = Window.partitionBy(*(groups or [F.lit(0)]))
    before = within.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
            F.sum("_n").over(within).alias(size),
        )
    )
    ranked = rows.withColumn("_local", F.row_number().over(local) - 1)
    joined = ranked.join(starts, keys)
    return joined.withColumn(rank, F.col("_start") + F.col("_local")).drop("_start", "_local")


def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
    """The rows as written, each with a number of its own: rows that are equal can be told apart."""
    made = rows.withColumn(column, F.monotonically_increasing_id())
    return written(made, scratch_path(rows.sparkSession, name))


def range_bucketed(
    rows: DataFrame, order: Sequence[Column], bucket: str, name: str
) -> DataFrame:
    """The rows as written, with a ``bucket`` that rises with ``order``, of some even size.

    Splitters are sampled by Spark. Put a column of distinct values last in ``order``: rows that
    tie in all of it are in one bucket, however many they are.
    """
    dealt = rows.repartitionByRange(*order).withColumn(bucket, F.spark_partition_id())
    return written(dealt, scratch_path(rows.sparkSession, name))


def range_ranked(
    rows: DataFrame, order: Sequence[Column], rank: str, name: str
) -> DataFrame:
    """Add the 0-based place of each row in the ``order`` of all, by range partitions."""
    dealt = range_bucketed(rows, order, "_range", name)
    return ranked_in_buckets(dealt, [], "_range", order, rank, "_all").drop("_range", "_all")
