"""Spark-vs-DuckDB comparison, the same check the driver makes."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


import os

EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records, cols):
    order = sorted(cols)
    return sorted((tuple(_norm(r[c]) for c in order) for r in records), key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols, r)) for r in res.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows differ spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ, first: {diff}"
    return True, f"{name}: ok ({len(s_rows)} rows)"
