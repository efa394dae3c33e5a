"""Compares a query with its SQL the way the outer check does: rows, column names, values, any order."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple((type(row[i]).__name__, _value(row[i])) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str | None:
    """None where both agree, else a short account."""
    cursor = connection.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    wanted = _bag(cursor.fetchall(), wanted_columns)
    if sorted(frame.columns) != sorted(wanted_columns):
        return f"columns {sorted(frame.columns)} and {sorted(wanted_columns)}"
    got = _bag([tuple(row) for row in frame.collect()], frame.columns)
    if got == wanted:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"rows {sum(got.values())} and {sum(wanted.values())}; "
        f"only in Spark {list(extra.items())[:3]}; only in SQL {list(missing.items())[:3]}"
    )
