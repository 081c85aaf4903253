"""DataFrame to DataFrame operators."""

from flowmetrics.operators.aggregate import (
    annual_mean,
    daily_mean,
    day_hour_rollup,
    day_type_mean,
    distinct_periods,
    four_grains,
    hourly_curve,
    mean_by,
    means_from_rollup,
    monthly_mean,
    period_summary,
)
from flowmetrics.operators.clean import (
    add_calendar,
    clean_readings,
    filter_years,
    label_period,
    label_period_by_join,
    label_readings,
    prepare_readings,
    prune_columns,
    round_columns,
)
from flowmetrics.operators.compare import (
    annual_change,
    baseline_comparison,
    change_vs_previous,
)
from flowmetrics.operators.distribution import distribution_by_period, distribution_of_readings
from flowmetrics.operators.rank import bottom_days, top_days
from flowmetrics.operators.reshape import (
    logical_order,
    matrix,
    pivot_hour_period,
    pivot_month_year,
    present_periods,
)

__all__ = [
    "add_calendar",
    "annual_change",
    "annual_mean",
    "baseline_comparison",
    "bottom_days",
    "change_vs_previous",
    "clean_readings",
    "daily_mean",
    "day_hour_rollup",
    "day_type_mean",
    "distinct_periods",
    "distribution_by_period",
    "distribution_of_readings",
    "filter_years",
    "four_grains",
    "hourly_curve",
    "label_period",
    "label_period_by_join",
    "label_readings",
    "logical_order",
    "matrix",
    "mean_by",
    "means_from_rollup",
    "monthly_mean",
    "period_summary",
    "pivot_hour_period",
    "pivot_month_year",
    "prepare_readings",
    "present_periods",
    "prune_columns",
    "round_columns",
    "top_days",
]
