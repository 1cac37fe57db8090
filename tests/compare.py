"""Run a registered query and its SQL side and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """One form for values that the engines type differently."""
    if isinstance(value, Decimal):
        return str(value.normalize()) if value else "0"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
