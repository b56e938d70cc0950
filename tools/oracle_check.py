"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [query ...]

Comparison: row count, column names, and the multiset of rows with columns
sorted by name (floats rounded to 6 places).  Prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bytes | bytearray):
        return bytes(v).hex()
    return v


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"{name:22s} rows={len(s_rows):7d} spark={t1 - t0:6.2f}s  (no oracle)"
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    ok = True
    msg = []
    if sorted(s_cols) != sorted(d_cols):
        ok = False
        msg.append(f"cols spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        ok = False
        msg.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if ok:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        cs = Counter(tuple(_norm(r[i]) for i in order_s) for r in s_rows)
        cd = Counter(tuple(_norm(r[i]) for i in order_d) for r in d_rows)
        if cs != cd:
            ok = False
            only_s = list((cs - cd).elements())[:2]
            only_d = list((cd - cs).elements())[:2]
            msg.append(f"values differ: {sum((cs - cd).values())} rows; spark-only={str(only_s)[:600]} duck-only={str(only_d)[:600]}")
    status = "OK  " if ok else "FAIL"
    return f"{status} {name:22s} rows={len(s_rows):7d} spark={t1 - t0:6.2f}s duck={t2 - t1:6.2f}s {' | '.join(msg)}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from alertlake.plans.registry import ORACLE, QUERIES
    from alertlake.session import get_spark
    spark = get_spark("local[8]")
    con = duck(sf_dir)
    fails = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        try:
            line = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as e:  # report and continue
            line = f"ERR  {name:22s} {type(e).__name__}: {str(e)[:800]}"
        fails += not line.startswith("OK")
        print(line, flush=True)
    print(f"done: {fails} not OK")


if __name__ == "__main__":
    main(sys.argv)
