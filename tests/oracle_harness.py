"""Spark-vs-DuckDB comparison in the style of the driver's correctness gate."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_cell(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def spark_rows(df):
    rows = [tuple(r) for r in df.collect()]
    return list(df.columns), [tuple(x.asDict(recursive=True) if hasattr(x, "asDict") else x for x in r)
                              for r in rows]


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols, s_rows = spark_rows(sdf)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out = {"rows_spark": len(s_rows), "rows_oracle": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    out["hash_match"] = out["cols_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    return out, (s_cols, s_rows), (d_cols, d_rows)
