"""Scans of raw readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowmetrics import fixed
from flowmetrics.schema import RAW_SCHEMA


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = RAW_SCHEMA,
    sep: str = fixed.RAW_SEPARATOR,
    infer: bool = False,
) -> DataFrame:
    """Headered delimited files; ``paths`` may hold globs such as ``raw/*/*.csv``.

    With a declared schema the header of every file is checked, so a file with its columns in
    another order fails instead of being misread; a field that does not fit its type is NULL.
    ``infer=True`` asks Spark for the types, which costs one more pass over the input.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if infer:
        reader = reader.option("inferSchema", True)
    else:
        reader = (
            reader.schema(schema)
            .option("enforceSchema", False)
            .option("timestampNTZFormat", fixed.TIMESTAMP_PATTERN)
        )
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet readings, such as those ``write_clean_readings`` leaves."""
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
