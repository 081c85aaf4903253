"""Compares a Spark result with DuckDB's on the same Parquet tables."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, _sorted([tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    picked = ", ".join(f'"{c}"' for c in cols)
    return cols, _sorted(con.sql(f"SELECT {picked} FROM ({sql})").fetchall())


# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def types_match(df, con, sql: str) -> list[tuple[str, str, str]]:
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, t, duck[c]) for c, t in df.dtypes if TYPES.get(t) != duck[c]]
