"""Runs registered queries next to their SQL and reports differences."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("nation", "customer", "orders", "lineitem")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", value)
    if isinstance(value, dt.datetime):
        return ("datetime", value.isoformat())
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i].lower() for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def difference(df, con, sql: str) -> str:
    """Empty if both give the same columns, types of value and rows."""
    cursor = con.execute(sql)
    wanted_columns, wanted = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    columns, rows = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if columns != wanted_columns:
        return f"columns {columns} instead of {wanted_columns}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows instead of {len(wanted)}"
    wrong = [(a, b) for a, b in zip(rows, wanted) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0][0]} instead of {wrong[0][1]}"
    kinds = [(c, type(a), type(b)) for r, w in zip(rows, wanted) for c, a, b in zip(columns, r, w)
             if type(a) is not type(b)]
    return f"types differ: {kinds[0]}" if kinds else ""
