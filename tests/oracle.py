"""Shared Spark-vs-DuckDB comparison used by tests and tools/compare.py."""

from __future__ import annotations

import hashlib
import math

import duckdb

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return "0" if v == 0 else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql: str):
    """Returns None when equal, else a short description of the difference."""
    cols = spark_df.columns
    rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(cols) != sorted(ocols):
        return f"columns {sorted(cols)} vs {sorted(ocols)}"
    h1, l1 = digest(rows, cols)
    h2, l2 = digest(orows, ocols)
    if h1 != h2:
        diff = sorted(set(l1) ^ set(l2))[:4]
        return f"rows {len(rows)} vs {len(orows)}; differing: {diff}"
    return None
