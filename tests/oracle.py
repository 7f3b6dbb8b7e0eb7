"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in NAMES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        return repr(float(value))
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())
