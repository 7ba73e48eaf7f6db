"""Runs every registered query next to its SQL counterpart."""

from __future__ import annotations

import datetime
import math
import pathlib
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = pathlib.Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(plain(row[i]) for i in order) for row in rows),
    )


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(row) for row in frame.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    return rows_of([column[0] for column in result.description], result.fetchall())
