"""Result tables: write, reload, combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmetrics.functions.numbers import nan_to_null
from flowmetrics.names import NAMES, Names
from flowmetrics.operators.clean import round_columns
from flowmetrics.schema import result_schemas

FORMATS = ("parquet", "csv")


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table at ``path``; CSV files get a header."""
    _check_format(fmt)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_tables(
    tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Write each table to a directory of its name below ``root``; return the paths."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        write_table(df, paths[name], fmt)
    return paths


def has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether any file below ``path`` has a name like ``pattern``; one job that stops at the
    first, and no list of files on the driver."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return not files.load(path).select("path").isEmpty()


def reload_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "csv",
    check_header: bool = True,
) -> DataFrame:
    """All part files of a result directory as one table; NaN becomes NULL.

    A directory without part files raises ``FileNotFoundError``: with a declared schema Spark
    itself would return an empty table. ``check_header=False`` accepts CSV files whose header
    spells the same columns differently.
    """
    _check_format(fmt)
    reader = spark.read.option("pathGlobFilter", f"*.{fmt}")
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            reader = reader.option("enforceSchema", not check_header)
    df = reader.format(fmt).load(path)
    if not has_files(spark, path, f"*.{fmt}"):
        raise FileNotFoundError(f"no {fmt} files in {path}")
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in doubles}) if doubles else df


def load_tables(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    decimals: int | None = None,
    names: Names = NAMES,
) -> dict[str, DataFrame]:
    """The four first-tier tables below ``root``, rounded when ``decimals`` is given."""
    tables = {
        name: reload_table(spark, f"{root.rstrip('/')}/{name}", schema, fmt)
        for name, schema in result_schemas(names).items()
    }
    return tables if decimals is None else rounded_tables(tables, decimals, names)


def rounded_tables(
    tables: Mapping[str, DataFrame], decimals: int, names: Names = NAMES
) -> dict[str, DataFrame]:
    """The same tables with their mean and median columns rounded."""
    values = [names.mean, names.median, names.day_mean]
    return {name: round_columns(df, values, decimals) for name, df in tables.items()}


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name, absent ones NULL."""
    if not parts:
        raise ValueError("union_parts: no parts")
    left = list(parts)
    while len(left) > 1:  # in pairs, so that the plan is a logarithm deep
        pairs = zip(left[::2], left[1::2])
        joined = [a.unionByName(b, allowMissingColumns=True) for a, b in pairs]
        left = joined + left[len(joined) * 2 :]
    return left[0]


def write_clean_readings(
    readings: DataFrame, path: str, names: Names = NAMES, partition_by_year: bool = True
) -> None:
    """Clean readings as Parquet, one directory per year.

    Later jobs then scan two typed columns and, through ``filter_years``, only the years they
    need. Rows are dealt to files of even size, however small or large the files they come from:
    Spark splits a year with most of the rows and joins small ones.
    """
    if partition_by_year:
        readings = readings.withColumn(names.year, F.year(names.time)).hint("rebalance", names.year)
        readings.write.mode("overwrite").partitionBy(names.year).parquet(path)
    else:
        readings.hint("rebalance").write.mode("overwrite").parquet(path)
