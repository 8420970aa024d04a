"""Run driver queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}", t1 - t0, t2 - t1
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}", t1 - t0, t2 - t1
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[:3]}", t1 - t0, t2 - t1
    return True, f"{len(a)} rows", t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tessera.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    ok_all = True
    for name in (names or list(qs)):
        if name not in os_:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS  {name:28s} {n} rows  spark {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            ok, msg, ts, td = compare(spark, con, name, qs[name], os_[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, ts, td = False, f"error: {type(e).__name__}: {str(e)[:400]}", 0, 0
        ok_all &= ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:28s} {msg}  spark {ts:.1f}s duck {td:.1f}s",
              flush=True)
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
