"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Rows are compared order-insensitively with columns sorted by name; floats are compared
after rounding to 9 significant digits.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math


STRICT = False  # True: floats must be bit-identical (no rounding)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def duckdb_connection(sf_dir: str, tables):
    import duckdb
    con = duckdb.connect()
    for n in tables:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf_dir}/{n}.parquet')")
    return con


def compare(spark, sf_dir: str, name: str, query_fn, sql: str | None, con) -> dict:
    df = query_fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    res["oracle_rows"] = len(o_rows)
    sc, sr = normalise(s_cols, s_rows)
    oc, orr = normalise(o_cols, o_rows)
    if sc != oc:
        res["status"] = "schema"
        res["detail"] = f"spark={sc} oracle={oc}"
    elif sr != orr:
        res["status"] = "values"
        diff = [(a, b) for a, b in zip(sr, orr) if a != b][:2]
        res["detail"] = repr(diff)[:600] if diff else f"count {len(sr)} vs {len(orr)}"
    else:
        res["status"] = "ok"
    return res
