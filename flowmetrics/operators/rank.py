"""Days with the highest and the lowest mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics import fixed
from flowmetrics.names import NAMES, Names
from flowmetrics.operators.clean import round_columns


def _rounded(daily: DataFrame, pre_round: int | None, names: Names) -> DataFrame:
    daily = daily.select(names.day, names.day_mean)
    return daily if pre_round is None else round_columns(daily, [names.day_mean], pre_round)


def top_days(
    daily: DataFrame,
    n: int = fixed.TOP_N,
    pre_round: int | None = fixed.DECIMALS,
    names: Names = NAMES,
) -> DataFrame:
    """The ``n`` days with the highest mean; of equal ones the earlier first."""
    order = [F.desc_nulls_last(names.day_mean), F.asc(names.day)]
    return _rounded(daily, pre_round, names).orderBy(*order).limit(n)


def bottom_days(
    daily: DataFrame,
    n: int = fixed.TOP_N,
    pre_round: int | None = fixed.DECIMALS,
    names: Names = NAMES,
) -> DataFrame:
    """The ``n`` days with the lowest mean; of equal ones the earlier first."""
    order = [F.asc_nulls_last(names.day_mean), F.asc(names.day)]
    return _rounded(daily, pre_round, names).orderBy(*order).limit(n)
