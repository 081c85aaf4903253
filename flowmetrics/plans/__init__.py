"""Whole jobs built from the operators."""

from flowmetrics.plans.report import (
    basic_report,
    figure_tables,
    first_tier,
    full_report,
    run_report,
)

__all__ = ["basic_report", "figure_tables", "first_tier", "full_report", "run_report"]
