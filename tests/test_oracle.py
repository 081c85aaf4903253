"""Every registered query against its SQL equivalent in DuckDB."""

import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F
from tests.oracle import connect, duck_rows, spark_rows, types_match

QUERIES = contract.own_queries()
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}
ROOT = "/root/testdata/sf"


@pytest.fixture(scope="module", params=["0.001", "0.01", "0.001 split"])
def tables(request, spark, tmp_path_factory):
    """Folder read by Spark and folder read by DuckDB.

    The last pair holds the same rows, but Spark reads them shuffled into many files, one of
    them with half the rows: no result may depend on how the rows lie.
    """
    sf, *split = request.param.split()
    if not split:
        return ROOT + sf, ROOT + sf
    folder = tmp_path_factory.mktemp("split")
    for name in ("orders", "events"):
        rows = spark.read.parquet(f"{ROOT}{sf}/{name}.parquet")
        part = F.when(F.rand(1) < 0.5, 0).otherwise(F.floor(F.rand(2) * 40))
        spread = rows.withColumn("part", part).repartition(23, "part")
        shuffled = spread.sortWithinPartitions(F.rand(3)).drop("part")
        shuffled.write.parquet(f"{folder}/{name}.parquet")
    return str(folder), ROOT + sf


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    spark_dir, duck_dir = tables
    con = connect(duck_dir)
    df = QUERIES[name](spark, spark_dir)
    spark_cols, got = spark_rows(df)
    duck_cols, want = duck_rows(con, SQL[name])
    assert spark_cols == duck_cols
    assert types_match(df, con, SQL[name]) == []
    assert len(got) == len(want)
    assert got == want


def test_every_sql_has_a_query():
    assert set(QUERIES) == set(SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 5
