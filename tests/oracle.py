"""Compare a Spark result with DuckDB's answer to the query's SQL, value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else str(_plain(r[i])) for i in order) for r in rows)


def differences(df, con, sql) -> list[str]:
    """Empty when columns, row count and every value agree."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = _rows(names, answer.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return [f"rows {len(got)} != {len(want)}"]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return [f"{len(bad)} rows differ, first {bad[0]}"] if bad else []
