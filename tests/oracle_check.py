"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((cell is None, str(type(cell)), cell or 0) for cell in row))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _sorted([tuple(row) for row in df.select(*columns).collect()])


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    names = [name for name, *_ in con.execute(f"DESCRIBE {sql}").fetchall()]
    columns = sorted(names)
    picked = ", ".join(f'"{name}"' for name in columns)
    return columns, _sorted(con.execute(f"SELECT {picked} FROM ({sql})").fetchall())


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values must be equal, floats to the last digit, types too."""
    columns, found = spark_rows(spark_df)
    expected_columns, expected = oracle_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(found) != len(expected):
        return f"{len(found)} rows != {len(expected)}"
    for left, right in zip(found, expected):
        for name, a, b in zip(columns, left, right):
            if type(a) is not type(b) or not (a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))):
                return f"{name}: {a!r} != {b!r} in {left!r} / {right!r}"[:2000]
    return None
