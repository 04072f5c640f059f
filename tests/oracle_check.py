"""Run a registered query in Spark and its oracle in DuckDB; compare exactly.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def compare(spark, con, name: str, sf_dir: str, fn, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark-only {set(s_cols) - set(d_cols)} duck-only {set(d_cols) - set(s_cols)}"
    order = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in order]
    d_idx = [d_cols.index(c) for c in order]
    s_set = Counter(tuple(norm(r[i]) for i in s_idx) for r in s_rows)
    d_set = Counter(tuple(norm(r[i]) for i in d_idx) for r in d_rows)
    info = f"rows spark={len(s_rows)} duck={len(d_rows)} ({t1 - t0:.1f}s / {t2 - t1:.1f}s)"
    if s_set == d_set:
        return True, info
    only_s = list((s_set - d_set).elements())[:2]
    only_d = list((d_set - s_set).elements())[:2]
    # locate differing columns
    diff_cols = set()
    for a, b in zip(only_s, only_d):
        for c, x, y in zip(order, a, b):
            if x != y:
                diff_cols.add(c)
    return False, f"{info} differ cols={sorted(diff_cols)}\n  spark: {only_s[:1]}\n  duck:  {only_d[:1]}"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from quitanda.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in os_:
            df = qs[name](spark, sf_dir)
            print(f"ROWS-ONLY {name}: {df.count()} rows")
            continue
        try:
            ok, info = compare(spark, con, name, sf_dir, qs[name], os_[name])
        except Exception as exc:  # noqa: BLE001
            ok, info = False, f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {info}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
