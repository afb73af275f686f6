"""Run registered queries in Spark and their SQL in DuckDB, compare order-insensitively.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from liftkit.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark-only={set(scols) - set(dcols)} duck-only={set(dcols) - set(scols)}", t1 - t0
    a, b = canon(scols, srows), canon(dcols, drows)
    if len(a) != len(b):
        return False, f"rows spark={len(a)} duck={len(b)}", t1 - t0
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return False, f"values differ ({len(a)} rows), e.g. {diffs}", t1 - t0
    return True, f"{len(a)} rows", t1 - t0


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from liftkit.session import get_spark

    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        if k not in sqls:
            t0 = time.time()
            n = qs[k](spark, sf_dir).count()
            print(f"[rows] {k}: {n} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            ok, msg, secs = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as e:  # report and continue
            ok, msg, secs = False, f"error: {type(e).__name__}: {str(e)[:400]}", 0.0
        bad += not ok
        print(f"[{'ok' if ok else 'FAIL'}] {k}: {msg} ({secs:.1f}s)")
    print(f"failures: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
