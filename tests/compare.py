"""Run a query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt

import duckdb

from dosecast.queries.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    """One form for values that the two engines hold differently."""
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=key)


def check(spark_df, con, sql):
    """(same, message) for one query."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return False, f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows"
    first = next(((a, b) for a, b in zip(got, want) if a != b), None)
    return False, f"{len(got)} rows, expected {len(want)}; first difference {first}"
