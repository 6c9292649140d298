"""Run registered queries beside their SQL in DuckDB and compare rows, columns and values.

usage: python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from larder.plans import catalog  # noqa: E402
from larder.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return "null" if value is None else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--quiet", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    root = f"/root/testdata/sf{args.sf}"
    spark = local_session("check")
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{root}/{table}.parquet'")
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = fn(spark, root)
            rows = [tuple(r) for r in df.collect()]
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        sql = catalog.SQL.get(name)
        if sql is None:
            print(f"rows  {name}: {len(rows)} rows, {took:.1f}s  {rows[:2] if not args.quiet else ''}", flush=True)
            continue
        try:
            start = time.time()
            result = db.execute(sql)
            names = [d[0] for d in result.description]
            kinds = {d[0]: str(d[1]) for d in result.description}
            want = normal(names, result.fetchall())
            sql_took = time.time() - start
        except Exception as error:
            print(f"SQL ERROR {name}: {str(error)[:800]}", flush=True)
            bad += 1
            continue
        got = normal(df.columns, rows)
        if got == want:
            same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
            off = [f"{c}:{k}/{kinds[c]}" for c, k in df.dtypes if same.get(k, k) != kinds[c]]
            print(f"ok    {name}: {len(rows)} rows, {took:.1f}s, sql {sql_took:.1f}s {'types ' + str(off) if off else ''}", flush=True)
        else:
            bad += 1
            print(f"DIFF  {name}: {len(got[1])} vs {len(want[1])} rows, columns {got[0]} vs {want[0]}")
            a, b = set(got[1]), set(want[1])
            print("   only spark:", sorted(a - b)[:4], "\n   only sql:  ", sorted(b - a)[:4], flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
