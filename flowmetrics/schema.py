"""Declared schemas and the required-column check made at operator entry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowmetrics import fixed
from flowmetrics.names import NAMES, Names

_RAW_TYPES = {
    "id": T.LongType(),
    "fecha": T.TimestampNTZType(),
    "intensidad": T.DoubleType(),
    "ocupacion": T.IntegerType(),
    "carga": T.IntegerType(),
    "vmed": T.DoubleType(),
    "periodo_integracion": T.IntegerType(),
}

# The CSV reader turns text that does not fit a type into NULL and keeps the row, so times and
# values are parsed once, in the scan, and the cleaning step drops the NULLs.
RAW_SCHEMA = T.StructType(
    [T.StructField(c, _RAW_TYPES.get(c, T.StringType())) for c in fixed.RAW_COLUMNS]
)


def result_schemas(names: Names = NAMES) -> dict[str, T.StructType]:
    """Schemas of the four first-tier tables, keyed by directory name."""
    period = T.StructField(names.period, T.StringType())
    mean = T.StructField(names.mean, T.DoubleType())
    return {
        fixed.SUMMARY_TABLE: T.StructType(
            [period, mean, T.StructField(names.median, T.DoubleType())]
        ),
        fixed.MONTHLY_TABLE: T.StructType(
            [
                T.StructField(names.year, T.IntegerType()),
                T.StructField(names.month, T.IntegerType()),
                mean,
            ]
        ),
        fixed.HOURLY_TABLE: T.StructType(
            [period, T.StructField(names.hour, T.IntegerType()), mean]
        ),
        fixed.DAILY_TABLE: T.StructType(
            [
                T.StructField(names.day, T.DateType()),
                T.StructField(names.day_mean, T.DoubleType()),
            ]
        ),
    }


def require_columns(df: DataFrame, columns: Iterable[str], where: str) -> None:
    """Raise ``ValueError`` naming every missing column; no job is run."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}; have {df.columns}")
