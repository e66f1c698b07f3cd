"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as se
    qs, oracles = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            cols = sorted(sdf.columns)
            srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            results[name] = f"spark error: {exc!r}"[:400]
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        sql = oracles.get(name)
        if sql is None:
            results[name] = f"no oracle ({len(srows)} rows)"
            print(name, results[name], flush=True)
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            odata = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"oracle error: {exc!r}"[:600]
            print(name, results[name], flush=True)
            continue
        idx = {c: i for i, c in enumerate(ocols)}
        if sorted(ocols) != cols:
            results[name] = f"columns differ: spark {cols} oracle {sorted(ocols)}"
            print(name, results[name], flush=True)
            continue
        orows = [tuple(norm(r[idx[c]]) for c in cols) for r in odata]
        a, b = sorted(srows, key=key), sorted(orows, key=key)
        if a == b:
            results[name] = "ok"
            msg = f"ok rows={len(a)} spark={ts:.2f}s"
        else:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            results[name] = f"MISMATCH spark={len(a)} oracle={len(b)}"
            msg = results[name] + f" first diffs: {diff}" + f" cols={cols}"
        if verbose:
            print(name, msg, flush=True)
    return results


if __name__ == "__main__":
    from cohortline.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "ok"}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("  ", k, v[:300])
