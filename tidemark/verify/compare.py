"""Compare a query with its SQL on the same folder, value by value."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame


def engine(sf_dir: str):
    """The checking engine with every test table as a view."""
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: [(v is None, type(v).__name__, v) for v in r])


def differences(df: DataFrame, connection, sql: str, show: int = 3) -> list[str]:
    """Empty if columns, row count and all values agree."""
    wanted = connection.sql(sql)
    if sorted(df.columns) != sorted(wanted.columns):
        return [f"columns: {sorted(df.columns)} != {sorted(wanted.columns)}"]
    got = _canonical(df.columns, df.collect())
    expected = _canonical(wanted.columns, wanted.fetchall())
    problems = []
    if len(got) != len(expected):
        problems.append(f"rows: {len(got)} != {len(expected)}")
    if got != expected:
        only_got = [r for r in got if r not in set(expected)][:show]
        only_expected = [r for r in expected if r not in set(got)][:show]
        problems.append(f"values: got {only_got}, expected {only_expected}")
    return problems
