"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Comparison: row count, column names, and an order-insensitive hash of the
values (columns sorted by name), like the driver's correctness gate.

    python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main(argv):
    import duckdb
    from feedcat.session import get_spark
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    ok = bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        same = (sorted(scols) == sorted(dcols)) and len(srows) == len(drows) and hs == hd
        if same:
            ok += 1
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: spark {len(srows)} rows {sorted(scols)} vs duck {len(drows)} rows {sorted(dcols)}")
            a, b = set(ls), set(ld)
            for x in sorted(a - b)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck  only:", x[:300])
    print(f"summary ok={ok} bad={bad}")
    return 0 if bad == 0 else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
