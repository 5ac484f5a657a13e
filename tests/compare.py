"""Order-insensitive comparison of a Spark result with its SQL on the same files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        if value != value:
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str | None:
    """None when columns and rows agree, else a short account of what differs."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = _rows(names, expected.fetchall())
    got = _rows(df.columns, df.collect())
    if want == got:
        return None
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"only in Spark {list((got - want).items())[:3]}; only in SQL {list((want - got).items())[:3]}"
    )
