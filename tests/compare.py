"""Run registered queries beside their DuckDB counterparts and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from catalog.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int | float | decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows(columns: list[str], values) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in values)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), rows(names, cursor.fetchall())
