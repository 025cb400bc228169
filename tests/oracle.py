"""Compare a query with its SQL, whatever the order of rows and columns."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return (type(value).__name__, "nan")
    return (type(value).__name__, value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows), key=lambda r: [(v is None, str(v)) for _, v in r]
    )


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(con: duckdb.DuckDBPyConnection, text: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(text)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())


def difference(df, con: duckdb.DuckDBPyConnection, text: str) -> str | None:
    """None where both give the same columns, types and values; else what differs first."""
    have_columns, have = spark_rows(df)
    want_columns, want = sql_rows(con, text)
    if have_columns != want_columns:
        return f"columns {have_columns} against {want_columns}"
    if len(have) != len(want):
        return f"{len(have)} rows against {len(want)}"
    if not have:
        return "no rows"
    for a, b in zip(have, want):
        if a != b:
            return f"row {a} against {b}"
    return None
