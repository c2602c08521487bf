"""Compare a Spark query with its check SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from scenetrail.plans.derived import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def check_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if left[1] == right[1]:
        return None
    only_left = [r for r, s in zip(left[1], right[1]) if r != s][:3]
    only_right = [s for r, s in zip(left[1], right[1]) if r != s][:3]
    return f"rows {len(left[1])} / {len(right[1])}; first differences {only_left} / {only_right}"
