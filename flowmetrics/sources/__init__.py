"""Scans, sinks and scratch tables."""

from flowmetrics.sources.readings import read_delimited, read_parquet
from flowmetrics.sources.scratch import scratch_folder, scratch_path, written
from flowmetrics.sources.tables import (
    load_tables,
    reload_table,
    rounded_tables,
    union_parts,
    write_clean_readings,
    write_table,
    write_tables,
)

__all__ = [
    "load_tables",
    "read_delimited",
    "read_parquet",
    "reload_table",
    "rounded_tables",
    "scratch_folder",
    "scratch_path",
    "union_parts",
    "write_clean_readings",
    "write_table",
    "write_tables",
    "written",
]
