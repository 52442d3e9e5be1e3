"""Runs a query on Spark and its SQL on DuckDB and tells how the results differ."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime | datetime.date):
        return value.isoformat()
    return f"{type(value).__name__} {value}"


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, found.fetchall())
    if ours == theirs:
        return []
    out = [f"rows {sum(ours.values())} vs {sum(theirs.values())}"]
    out += [f"only spark: {str(r)[:300]}" for r in list((ours - theirs))[:3]]
    out += [f"only sql:   {str(r)[:300]}" for r in list((theirs - ours))[:3]]
    return out
