"""Run every registered query in Spark and its SQL twin in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match and value match.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok_all = True
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        dt = time.time() - t
        if name not in sqls:
            print(f"{name:24s} spark={len(rows):7d} rows (no oracle) {dt:6.2f}s")
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        same_cols = sorted(cols) == sorted(ocols)
        if same_cols:
            idx = [ocols.index(c) for c in sorted(cols)]
            sidx = [cols.index(c) for c in sorted(cols)]
            a = Counter(tuple(_norm(r[i]) for i in sidx) for r in rows)
            b = Counter(tuple(_norm(r[i]) for i in idx) for r in orows)
            same_vals = a == b
        else:
            same_vals = False
        ok = same_cols and same_vals and len(rows) == len(orows)
        ok_all &= ok
        print(f"{name:24s} spark={len(rows):7d} duck={len(orows):7d} cols={'ok' if same_cols else 'DIFF'} "
              f"vals={'ok' if same_vals else 'DIFF'} {dt:6.2f}s")
        if not ok:
            if not same_cols:
                print("   spark cols", cols, "\n   duck cols ", ocols)
            else:
                diff1 = list((a - b).items())[:3]
                diff2 = list((b - a).items())[:3]
                print("   spark-only", diff1, "\n   duck-only ", diff2)
    return ok_all


if __name__ == "__main__":
    from ledgerline import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = set(sys.argv[2:]) or None
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ok = compare(spark, sf_dir, names)
    print("ALL OK" if ok else "MISMATCH")
