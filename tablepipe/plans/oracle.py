"""Side-by-side check of a registered query against its DuckDB oracle:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

from tablepipe.plans._base import TABLES


def norm(v) -> str:
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    same = (len(rows) == len(orows) and sorted(cols) == sorted(ocols)
            and digest(cols, rows) == digest(ocols, orows))
    return same, f"spark {len(rows)} rows {cols} / oracle {len(orows)} rows {ocols}"
