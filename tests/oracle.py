"""Compare a Spark result with DuckDB oracle SQL (names, rows, values)."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", f"{float(v):.12g}") if abs(v) < 2**53 else ("i", v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if f != f:
            return ("nan",)
        return ("n", f"{f:.12g}")
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((str(k), norm(x)) for k, x in v.items())))
    return ("s", str(v))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    rows = spark_df.collect()
    s_cols = spark_df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(rows) != len(d_rows):
        return False, f"row count spark={len(rows)} duck={len(d_rows)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = Counter(tuple(norm(r[i]) for i in order) for r in rows)
    b = Counter(tuple(norm(r[i]) for i in d_order) for r in d_rows)
    if a != b:
        diff_a = list((a - b).items())[:3]
        diff_b = list((b - a).items())[:3]
        return False, f"values differ; spark-only {diff_a} duck-only {diff_b}"
    return True, f"{len(rows)} rows"
