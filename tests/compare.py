"""Spark-vs-DuckDB comparison of registered queries.

Row count, column names, column type families and an order-insensitive
multiset of normalised rows must all agree.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import re
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def spark_family(t: str) -> str:
    t = t.lower()
    if t.startswith("decimal"):
        return t.replace(" ", "")
    return {"string": "str", "bigint": "i64", "int": "i32", "smallint": "i16", "double": "f64", "float": "f32",
            "timestamp_ntz": "ts", "timestamp": "tstz", "date": "date", "boolean": "bool"}.get(t, t)


def duck_family(t: str) -> str:
    t = t.upper()
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return {"VARCHAR": "str", "BIGINT": "i64", "INTEGER": "i32", "SMALLINT": "i16", "DOUBLE": "f64", "FLOAT": "f32",
            "TIMESTAMP": "ts", "TIMESTAMP WITH TIME ZONE": "tstz", "DATE": "date", "BOOLEAN": "bool"}.get(t, t)


def table_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: spark_family(f.dataType.simpleString()) for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: duck_family(str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows)}
    sc, sc_rows = table_of(s_cols, s_rows)
    dc, dc_rows = table_of(d_cols, d_rows)
    out["cols_match"] = sc == dc
    out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_cols) | set(d_cols)
                        if s_types.get(c) != d_types.get(c)}
    out["values_match"] = sc_rows == dc_rows
    if not out["cols_match"]:
        out["cols"] = (sc, dc)
    if not out["values_match"]:
        only_s = list((sc_rows - dc_rows).elements())[:3]
        only_d = list((dc_rows - sc_rows).elements())[:3]
        out["only_spark"], out["only_duck"] = only_s, only_d
    out["ok"] = out["cols_match"] and out["values_match"] and not out["type_diff"] and len(s_rows) == len(d_rows)
    return out


def fmt(res: dict) -> str:
    keep = {k: v for k, v in res.items() if k not in ("name",)}
    return f"{res['name']}: " + re.sub(r"\s+", " ", repr(keep))[:1500]
