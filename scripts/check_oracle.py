"""Run registered queries in Spark and their DuckDB oracles; compare rows, schema and values.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from brieflow.session import get_session  # noqa: E402
from brieflow.plans.catalog import QUERIES  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        fn, sql = QUERIES[name]
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as exc:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"{name}: rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sql)
            ocols = rel.columns
            orows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
        except Exception as exc:  # noqa: BLE001
            print(f"{name}: ORACLE ERROR {str(exc)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        if ok_cols:
            order = [ocols.index(c) for c in scols]
            orows = [tuple(r[i] for i in order) for r in orows]
        key = lambda r: tuple((x is None, str(x)) for x in r)
        same = ok_cols and sorted(srows, key=key) == sorted(orows, key=key)
        status = "OK" if same else "MISMATCH"
        if not same:
            bad += 1
        print(f"{name}: {status} spark={len(srows)} oracle={len(orows)} cols_ok={ok_cols} {ts:.1f}s", flush=True)
        if not same and ok_cols:
            ss, os_ = set(map(str, srows)), set(map(str, orows))
            print("   only spark:", list(ss - os_)[:3])
            print("   only oracle:", list(os_ - ss)[:3])
        elif not ok_cols:
            print("   spark cols:", scols, " oracle cols:", ocols)
    print("bad:", bad)


if __name__ == "__main__":
    main()
