"""Run a registered Spark query and its DuckDB oracle on the same tables and
compare row count, column names and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return digest(df.columns, rows)


def duck_digest(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    rows = rel.fetchall()
    return digest(cols, rows)


def first_diff(df, con, sql, limit=5):
    a = sorted("|".join(_norm(x) for x in tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    b = sorted("|".join(_norm(r[i]) for i in order) for r in rel.fetchall())
    sa, sb = set(a), set(b)
    return sorted(sa - sb)[:limit], sorted(sb - sa)[:limit]
