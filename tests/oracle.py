"""Run a registered Spark query and its DuckDB oracle side by side.

Mirrors the external correctness gate: same column names, same row count,
same multiset of rows (order-insensitive).
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())


def compare(spark, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(duck(sf_dir), sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if sum(s_rows.values()) != sum(d_rows.values()):
        problems.append(f"row count spark={sum(s_rows.values())} duck={sum(d_rows.values())}")
    if not problems and s_rows != d_rows:
        only_s = list((s_rows - d_rows).items())[:3]
        only_d = list((d_rows - s_rows).items())[:3]
        problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return problems, sum(s_rows.values())
