"""Compare registered queries with their DuckDB statements on the same parquet files.

usage: check.py [--sf DIR] [--time] [name ...]
"""
from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

from growthloom.registry import ORACLE, QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()

# DuckDB type -> Spark types that hold the same values
SAME = {
    "BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"}, "VARCHAR": {"string"}, "BOOLEAN": {"boolean"},
    "DATE": {"date"}, "TIMESTAMP": {"timestamp_ntz"}, "FLOAT": {"float"}, "VARCHAR[]": {"array<string>"},
}


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return {k: norm(x) for k, x in v.items()}
    return v


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([norm(r[i]) for i in order]) for r in rows)


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{files}'")
    return con


def compare(spark, con, name: str, sf: str):
    """(problem or None, rows, seconds)"""
    t0 = time.time()
    df = QUERIES[name](spark, sf)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if name not in ORACLE:
        return None, len(rows), took
    rel = con.sql(ORACLE[name])
    dcols, drows = rel.columns, rel.fetchall()
    if sorted(cols) != sorted(dcols):
        return f"columns {sorted(cols)} vs {sorted(dcols)}", len(rows), took
    if len(rows) != len(drows):
        return f"rows {len(rows)} vs {len(drows)}", len(rows), took
    a, b = table(cols, rows), table(dcols, drows)
    if a != b:
        d1, d2 = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"{len(d1)} differ, spark {d1[:2]} duckdb {d2[:2]}"[:900], len(rows), took
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = [
        f"{c}: {stypes[c]} / {ty}" for c, ty in zip(dcols, map(str, rel.types))
        if stypes[c] not in SAME.get(ty, {stypes[c]})
        or ty in ("HUGEINT",)
    ]
    return (f"types {odd}" if odd else None), len(rows), took


def session(cpus: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--time", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark, con = session(os.environ.get("BENCH_CPUS", "8")), connect(args.sf)
    names = args.names or list(QUERIES)
    bad, empty, slow = 0, [], []
    for n in names:
        try:
            problem, rows, took = compare(spark, con, n, args.sf)
        except Exception as e:  # report and go on
            problem, rows, took = f"{type(e).__name__}: {str(e)[:500]}", -1, 0.0
        if problem:
            bad += 1
            print(f"BAD {n}: {problem}", flush=True)
        if rows == 0:
            empty.append(n)
        slow.append((took, n))
        if args.time or args.names:
            print(f"{'--' if problem else 'ok'} {n} rows={rows} {took:.2f}s", flush=True)
    print(f"{len(names)} queries, {bad} bad, {sum(n in ORACLE for n in names)} with oracle; empty: {empty}")
    print("slowest:", [(n, round(s, 1)) for s, n in sorted(slow, reverse=True)[:12]])
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
