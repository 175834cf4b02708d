"""Spark result vs DuckDB oracle: row count, column names, values.

Values are compared order-insensitively after sorting columns by name,
the way the round's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return bool(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=_key)


def compare(spark_df, con, sql):
    s_names = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_names = list(rel.columns)
    d_rows = rel.fetchall()
    sn, sr = rows_of(s_names, s_rows)
    dn, dr = rows_of(d_names, d_rows)
    problems = []
    if sn != dn:
        problems.append(f"columns differ: spark={sn} oracle={dn}")
    if len(sr) != len(dr):
        problems.append(f"row count: spark={len(sr)} oracle={len(dr)}")
    if not problems and sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(sr), len(dr)
