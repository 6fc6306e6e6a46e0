"""Compare a query with its SQL: same columns, same multiset of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """Empty if both sides agree."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = _rows(names, cursor.fetchall())
    actual = _rows(frame.columns, frame.collect())
    found = []
    if sorted(names) != sorted(frame.columns):
        found.append(f"columns {sorted(frame.columns)} against {sorted(names)}")
    if expected != actual:
        found.append(f"{actual.total()} rows against {expected.total()}")
        found += [f"only Spark: {row}" for row in list((actual - expected))[:3]]
        found += [f"only SQL:   {row}" for row in list((expected - actual))[:3]]
    return found
