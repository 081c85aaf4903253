"""Tables whose column names cannot clash with those an operator works with."""

from __future__ import annotations

from pyspark.sql import DataFrame


def apart(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with every column but the ``used`` ones named by its place.

    ``together`` gives the columns their names back, whatever they were.
    """
    return docs.toDF(*[c if c in used else f"column {i}" for i, c in enumerate(docs.columns)])


def together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows``, whose first columns are those of ``docs`` set apart, under the names of ``docs``."""
    return rows.toDF(*docs.columns, *rows.columns[len(docs.columns) :])
