"""Sorted results without a sampling job, for tables whose size the calendar bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def sorted_small(df: DataFrame, *keys: str | Column) -> DataFrame:
    """The rows sorted by ``keys`` in one partition.

    Meant for results of at most one row per day, hour, month or period: a global sort would
    first run the whole plan once more to sample its range bounds.
    """
    return df.repartition(1).sortWithinPartitions(*keys)
