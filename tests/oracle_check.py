"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``. Prints one line per query.
Also imported by ``tests/test_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    try:
        import pandas as pd
        if v is pd.NaT:
            return None
    except Exception:
        pass
    return v


def rows_of(cols, records, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)), [cols[i] for i in order]


def compare(spark, name: str, sf_dir: str, digits: int = 9):
    from brandpulse.plans import catalog
    q = catalog.REGISTRY[name]
    t0 = time.time()
    sdf = q.run(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t_spark = time.time() - t0
    if not q.sql:
        return {"name": name, "status": "no-oracle", "rows": len(srows), "spark_s": round(t_spark, 2)}
    con = duck(sf_dir)
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, ac = rows_of(scols, srows, digits)
    b, bc = rows_of(dcols, drows, digits)
    status = "ok"
    detail = ""
    if ac != bc:
        status, detail = "cols", f"spark={ac} duck={bc}"
    elif len(a) != len(b):
        status, detail = "rows", f"spark={len(a)} duck={len(b)}"
    elif a != b:
        status = "values"
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        detail = f"first diffs: {diffs}"
    return {"name": name, "status": status, "rows": len(a), "spark_s": round(t_spark, 2), "detail": detail}


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from brandpulse.session import get_spark
    from brandpulse.plans import catalog
    spark = get_spark("local[8]", shuffle_partitions=8)
    names = names or list(catalog.REGISTRY)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "error", "detail": repr(e)[:600]}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
