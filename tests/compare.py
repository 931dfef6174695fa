"""Compare a Spark result with DuckDB's: same columns, same kinds, same rows, exactly."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def difference(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    found = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {r[0].lower(): r[1] for r in found}
    ours = {n.lower(): KINDS.get(t, t) for n, t in df.dtypes}
    if ours != theirs:
        wrong = {k: (ours.get(k), theirs.get(k)) for k in set(ours) | set(theirs) if ours.get(k) != theirs.get(k)}
        return f"schema (spark, duckdb): {wrong}"
    a = _rows([tuple(r) for r in df.collect()], df.columns)
    b = _rows(con.execute(sql).fetchall(), [r[0] for r in found])
    if a == b:
        return None if sum(a.values()) else "no rows"
    left, right = a - b, b - a
    return f"{sum(left.values())} of {sum(a.values())} rows differ, {sum(right.values())} of {sum(b.values())}; e.g. {list(left)[:2]} | {list(right)[:2]}"
