"""Run every registered query in Spark and its oracle SQL in DuckDB on the
same parquet tables; compare row count, column names and an
order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        return norm(v.tolist())
    if isinstance(v, pd.Timestamp):
        return str(v.to_pydatetime())
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(rows):
    lines = sorted("|".join(norm(x) for x in r) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    from revlens.session import get_session
    import __spark_entry__ as E
    extra = {"spark.sql.session.timeZone": os.environ["SESSION_TZ"]} if os.environ.get("SESSION_TZ") else None
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false", **(extra or {})})
    if extra:
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            cols = sdf.columns
            srows = [tuple(r[c] for c in sorted(cols)) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows_raw = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
        drows = [tuple(r[i] for i in idx) for r in drows_raw]
        ok_cols = sorted(cols) == sorted(dcols)
        hs, ls = digest(srows)
        hd, ld = digest(drows)
        ok = ok_cols and len(srows) == len(drows) and hs == hd
        if not ok:
            bad += 1
            print(f"FAIL {name}: rows {len(srows)} vs {len(drows)} cols {sorted(cols)} vs {sorted(dcols)}")
            sld, sls = set(ld), set(ls)
            diff_s = [x for x in ls if x not in sld][:3]
            diff_d = [x for x in ld if x not in sls][:3]
            print("   spark-only:", diff_s)
            print("   duck-only: ", diff_d)
        else:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
