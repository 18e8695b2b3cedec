"""Run registered queries against their check SQL and compare whole results.

usage: python tools/check.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from schedlytics.queries import load
from schedlytics.session import build_session


def key(row):
    return tuple(f"{type(v).__name__}:{v}" for v in row)


def main(folder: str, names: list[str]) -> int:
    queries = load()
    spark = build_session("check", 8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    bad = []
    for name in names or list(queries):
        q = queries[name]
        try:
            t0 = time.time()
            df = q.run(spark, folder)
            left = [tuple(r) for r in df.collect()]
            t1 = time.time()
            sql = q.check_sql()
            if sql is None:
                print(f"rows-only {name:28s} rows={len(left):8d} spark={t1 - t0:6.2f}s", flush=True)
                continue
            right = con.execute(sql).fetchall()
            t2 = time.time()
            a, b = Counter(map(key, left)), Counter(map(key, right))
            ok = a == b and len(left) > 0
            note = "" if left else " EMPTY"
            print(f"{'ok  ' if ok else 'FAIL'} {name:28s} rows={len(left):8d}/{len(right)} spark={t1 - t0:6.2f}s sql={t2 - t1:5.2f}s{note}", flush=True)
            if not ok:
                bad.append(name)
                print("   only spark:", list((a - b).items())[:3])
                print("   only sql  :", list((b - a).items())[:3])
        except Exception as error:
            bad.append(name)
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:1500]}")
            if "-v" in sys.argv:
                traceback.print_exc()
    print(f"{len(bad)} failing: {bad}")
    return len(bad)


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("-")]
    sys.exit(min(main(args[0] if args else "/root/testdata/sf0.01", args[1:]), 99))
