"""Compare a Spark result with the result of plain SQL on the same files."""

from __future__ import annotations

import glob
import os
from datetime import date, datetime
from decimal import Decimal
from typing import Any

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def plain(value: Any) -> Any:
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return value


def _multiset(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows are equal, otherwise what differs first."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _multiset(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    actual = _multiset(frame.columns, [tuple(r) for r in frame.collect()])
    if actual == expected:
        return None
    extra = next((a for a in actual if a not in set(expected)), None)
    lacking = next((e for e in expected if e not in set(actual)), None)
    return f"{len(actual)} rows, expected {len(expected)}; extra {extra}; lacking {lacking}"
