"""Local parity check: Spark query vs. its DuckDB twin on the same tables.

Usage: python tools/parity.py [sf_dir] [key ...]
Prints one line per key: rows, schema and order-insensitive value hash.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from perkline.session import build_session
    from perkline.queries import QUERIES, TWINS, load_all

    load_all()
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    keys = keys or sorted(QUERIES)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            sdf = QUERIES[k](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in TWINS:
            print(f"ROWS {k}: spark rows={len(srows)} ({ts:.1f}s) [no twin]")
            continue
        try:
            res = con.execute(TWINS[k])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        if len(srows) != len(drows) or hs != hd:
            bad += 1
            print(f"FAIL {k}: rows spark={len(srows)} duck={len(drows)}")
            only_s = sorted(set(ls) - set(ld))[:3]
            only_d = sorted(set(ld) - set(ls))[:3]
            print("   cols:", sorted(scols))
            for x in only_s:
                print("   spark:", x[:300])
            for x in only_d:
                print("   duck: ", x[:300])
        else:
            print(f"OK   {k}: rows={len(srows)} ({ts:.1f}s)")
    print(f"{bad} failing of {len(keys)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
