"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate:
row count, sorted column names, and an order-insensitive multiset of
normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in data]


def compare(spark_df, con, sql) -> dict:
    s_cols, s_rows = rows_of_spark(spark_df)
    d_cols, d_rows = rows_of_duck(con, sql)
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "schema_match": s_cols == d_cols, "rows_match": len(s_rows) == len(d_rows)}
    cs, cd = Counter(s_rows), Counter(d_rows)
    res["value_match"] = res["schema_match"] and cs == cd
    if not res["value_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["only_spark"] = list((cs - cd).elements())[:3]
        res["only_oracle"] = list((cd - cs).elements())[:3]
    return res
