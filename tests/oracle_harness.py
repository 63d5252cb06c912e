"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: column names sorted, row counts, and an
order-insensitive comparison of values. Floats are compared both exactly
and with a relative tolerance; the report says which one held.

Run as a script to check every registered query:
    python tests/oracle_harness.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (np.floating,)):
        return None if np.isnan(v) else float(v)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _canon(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if v is pd.NaT:
        return None
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_canon(x) for x in rec))
    return cols, out


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def _close(a, b, rel=1e-9, abs_=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=abs_)
        except (TypeError, ValueError):
            return False
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y, rel, abs_) for x, y in zip(a, b))
    return a == b


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> dict:
    rep = {"rows_spark": len(spark_pdf), "rows_oracle": len(oracle_pdf)}
    sc, sr = _rows(spark_pdf)
    oc, orr = _rows(oracle_pdf)
    rep["columns_match"] = sc == oc
    if not rep["columns_match"]:
        rep["columns_spark"], rep["columns_oracle"] = sc, oc
        rep["exact"] = rep["close"] = False
        return rep
    sr.sort(key=_key)
    orr.sort(key=_key)
    rep["exact"] = sr == orr
    if rep["exact"]:
        rep["close"] = True
        return rep
    # tolerance compare: sort rows by their non-float parts then values
    def k2(r):
        return tuple((0, "") if x is None else (1, repr(round(x, 6)) if isinstance(x, float)
                                                else repr(x)) for x in r)
    sr.sort(key=k2)
    orr.sort(key=k2)
    bad = [(a, b) for a, b in zip(sr, orr) if not _close(a, b)]
    rep["close"] = len(sr) == len(orr) and not bad
    if bad:
        rep["first_diff"] = [str(bad[0][0])[:300], str(bad[0][1])[:300]]
    return rep


def run_all(sf_dir: str, only=None):
    from scorecast.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    results = {}
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        t = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
            dt = time.time() - t
            if name in os_:
                odf = con.sql(os_[name]).df()
                rep = compare(sdf, odf)
            else:
                rep = {"rows_spark": len(sdf), "oracle": "none"}
            rep["sec"] = round(dt, 2)
        except Exception as e:  # report and continue
            rep = {"error": f"{type(e).__name__}: {str(e)[:400]}"}
        results[name] = rep
        status = ("OK " if rep.get("exact") else "~OK" if rep.get("close") else
                  "ROW" if rep.get("oracle") == "none" else "BAD")
        print(f"{status} {name}: {rep}", flush=True)
    return results


if __name__ == "__main__":
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run_all(d, sys.argv[2:] or None)
