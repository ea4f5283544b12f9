"""Runs a registered query and its SQL over the same tables and compares the rows, in no order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return str(value)[:19] if hasattr(value, "isoformat") else value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, folder: str, query, sql: str) -> list[str]:
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    cur = connect(folder).execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    if got != want:
        g, w = set(got), set(want)
        out.append(f"{len(got)} rows against {len(want)}; only in Spark {sorted(g - w, key=repr)[:3]}; only in SQL {sorted(w - g, key=repr)[:3]}")
    return out
