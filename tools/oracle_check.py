"""Run every registered query in Spark and its oracle SQL in DuckDB; compare results.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the order-insensitive multiset of rows
(doubles rounded to 6 places, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from rollbook.sources.tables import DRIVER_TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (x is not None and not isinstance(x, (list, dict, str))
                                        and _isnull(x)) else x) for x in rec))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def _kind(dtype: str) -> str:
    """Coarse pandas dtype family: int, float, bool, text/other."""
    d = dtype.lower()
    if d.startswith("int") or d.startswith("uint"):
        return "int"
    if d.startswith("float"):
        return "float"
    if d.startswith("bool"):
        return "bool"
    return "other"


def _isnull(x):
    try:
        import pandas as pd
        return bool(pd.isna(x))
    except (TypeError, ValueError):
        return False


def duck(sf_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from rollbook.catalog import ORACLE_SQL, QUERIES
    con = duck(sf_dir)
    results = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in ORACLE_SQL:
                results[name] = ("rows-only", len(sdf), None)
                continue
            odf = con.execute(ORACLE_SQL[name]).df()
            sc, sr = _rows(sdf)
            oc, orows = _rows(odf)
            ok = sc == oc and sr == orows
            detail = None
            if not ok:
                if sc != oc:
                    detail = f"cols spark={sc} oracle={oc}"
                else:
                    diff_s = [r for r in sr if r not in set(orows)][:3]
                    diff_o = [r for r in orows if r not in set(sr)][:3]
                    detail = f"rows spark={len(sr)} oracle={len(orows)} spark_only={diff_s} oracle_only={diff_o}"
            kinds = {c: (str(sdf[c].dtype), str(odf[c].dtype)) for c in sdf.columns if c in odf.columns}
            odd = {c: k for c, k in kinds.items() if _kind(k[0]) != _kind(k[1])}
            if odd:
                detail = (detail + "; " if detail else "") + f"dtypes {odd}"
            results[name] = ("ok" if ok else "MISMATCH", len(sr), detail)
        except Exception as e:  # noqa: BLE001
            t1 = time.time()
            results[name] = ("ERROR", None, f"{type(e).__name__}: {str(e)[:600]}")
        if verbose:
            st, n, det = results[name]
            print(f"{name:28s} {st:9s} rows={n} spark={t1 - t0:.1f}s" + (f"\n    {det}" if det else ""),
                  flush=True)
    return results


if __name__ == "__main__":
    from rollbook.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
