"""Run a registered Spark query and its DuckDB oracle; compare like the driver.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import os

import duckdb
import pandas as pd

EXACT = bool(os.environ.get("ORACLE_EXACT"))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x))) else x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, sf_dir: str, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir).toPandas()
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(sdf))
            if verbose:
                print(f"{name:28s} rows={len(sdf):7d} (no oracle) spark={t1-t0:.1f}s")
            continue
        ddf = con.execute(sqls[name]).df()
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        ok = sc == dc and sr == dr
        results[name] = ok
        if verbose:
            print(f"{name:28s} rows={len(sdf):7d}/{len(ddf):7d} cols={'ok' if sc == dc else (sc, dc)} "
                  f"{'MATCH' if ok else 'DIFF'} spark={t1-t0:.1f}s")
            if not ok and sc == dc:
                a, b = set(sr), set(dr)
                print("   spark-only", sorted(a - b, key=repr)[:3])
                print("   duck-only ", sorted(b - a, key=repr)[:3])
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from candlewick.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v is False]
    print("FAILED:", bad if bad else "none")
