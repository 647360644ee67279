"""Compare registered queries with their SQL: python tools/check.py [--sf DIR] [name ...]"""

from __future__ import annotations

import argparse
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from statlake.queries import ORACLES, QUERIES  # noqa: E402
from statlake.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    return f"{type(value).__name__}:{value}"


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def oracle_rows(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def compare(spark, sf, name):
    """None if equal, else what differs; and the row count and seconds."""
    start = time.time()
    df = QUERIES[name](spark, sf)
    names, rows = normal(df.columns, df.collect())
    seconds = time.time() - start
    if name not in ORACLES:
        return None if rows else "no rows", len(rows), seconds
    want_names, want = normal(*oracle_rows(sf, ORACLES[name]))
    if names != want_names:
        return f"columns {names} != {want_names}", len(rows), seconds
    if len(rows) != len(want):
        extra = [r for r in rows if r not in set(want)][:2]
        return f"rows {len(rows)} != {len(want)}; only here {extra}", len(rows), seconds
    for got, exp in zip(rows, want, strict=True):
        if got != exp:
            return f"{got} != {exp}", len(rows), seconds
    return None, len(rows), seconds


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    bad = 0
    for name in args.names or QUERIES:
        try:
            diff, n, seconds = compare(spark, args.sf, name)
        except Exception as exc:
            diff, n, seconds = f"{type(exc).__name__}: {str(exc)[:600]}", 0, 0.0
        bad += diff is not None
        oracle = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if diff else 'ok  '} {name:28} {oracle:4} {n:8} {seconds:7.2f}s {diff or ''}", flush=True)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
