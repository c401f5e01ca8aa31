"""Runs a query in Spark and its SQL in DuckDB and compares the rows as bags."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    return (type(value).__name__, value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def differences(df, connection, sql) -> str:
    """Empty when both sides agree in columns, value types and rows."""
    columns = df.columns
    mine = bag(columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = bag(names, result.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} vs {sorted(names)}"
    if mine == theirs:
        return ""
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} vs {sum(theirs.values())} rows, {sum(only_mine.values())} differ in {sorted(columns)}\n"
        f"  spark: {list(only_mine)[:2]}\n  sql:   {list(only_theirs)[:2]}"
    )
