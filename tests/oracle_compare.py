"""Run registered queries against their DuckDB oracle and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (columns sorted by
name, values exact).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    if v is None:
        return None
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir, names=None):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(name)
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows-only  spark_rows={len(srows)} ({ts:.2f}s)")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} ORACLE ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(name)
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and a == b
        status = "OK " if ok else "MISMATCH"
        print(f"{name:32s} {status} rows spark={len(a)} oracle={len(b)} ({ts:.2f}s)")
        if not ok:
            bad.append(name)
            if not ok_cols:
                print("   cols spark:", sorted(scols), "\n   cols duck: ", sorted(dcols))
            else:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only duck: ", list(sb - sa)[:3])
    return bad


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    bad = compare(spark, sf, names)
    print("FAILED:", bad)
    spark.stop()
