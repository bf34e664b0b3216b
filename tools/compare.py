"""Run queries on Spark and their SQL on DuckDB and compare the results.

Usage: python tools/compare.py [sf_dir] [topic or query name ...]
"""

from __future__ import annotations

import glob
import importlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    import duckdb

    import checks
    from merkmal.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    topics = [a for a in args if a in checks.MODULES]
    names = [a for a in args if a not in checks.MODULES]
    pairs = {}
    for topic in topics or checks.MODULES:
        pairs.update(importlib.import_module(f"checks.{topic}").PAIRS)
    if names:
        pairs = {n: p for n, p in pairs.items() if n in names}
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    duck = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = 0
    for name, (query, sql) in pairs.items():
        start = time.time()
        try:
            frame = query(spark, sf)
            got = [tuple(r) for r in frame.collect()]
            took = time.time() - start
            if not sql:
                print(f"rows  {name}: {len(got)} rows {took:.1f}s", flush=True)
                continue
            start = time.time()
            cursor = duck.execute(sql)
            wanted_columns = [d[0] for d in cursor.description]
            wanted = cursor.fetchall()
            other = time.time() - start
            a, b = rows_of(frame.columns, got), rows_of(wanted_columns, wanted)
            same = sorted(frame.columns) == sorted(wanted_columns) and a == b
            print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got)} rows, spark {took:.1f}s, sql {other:.1f}s", flush=True)
            if not same:
                bad += 1
                print("   columns", sorted(frame.columns), sorted(wanted_columns), len(a), len(b))
                print("   spark only", sorted(set(a) - set(b))[:3])
                print("   sql only  ", sorted(set(b) - set(a))[:3])
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {str(error)[:900]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
