"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", "") for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(v) for v in r) for r in df.select(*names).collect()), key=_key)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), sorted(rows, key=_key)
