"""Compare each registered Spark query with its DuckDB oracle.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [name ...]

Checks row count, column names, and the exact multiset of row values (after
sorting columns by name), which is what the correctness gate compares.
"""

from __future__ import annotations

import argparse
import collections
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return ("f", v)
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize())
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None))
    return (type(v).__name__, v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain-session", action="store_true",
                    help="use a bare SparkSession like the driver (no ledgerline defaults)")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    import importlib.util

    entry_path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                              "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry_under_test", entry_path)
    E = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(E)

    if args.plain_session:
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        from ledgerline.session import get_session

        spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    qs, oracle = E.queries(), E.oracle_sql()
    names = args.names or list(qs)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = qs[name](spark, args.sf)
            s_rows = df.collect()
            s_names = df.columns
            s_types = dict(df.dtypes)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(oracle[name])
            d_names = [c[0] for c in cur.description]
            d_types = {c[0]: str(c[1]) for c in cur.description}
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        problems = []
        if sorted(s_names) != sorted(d_names):
            problems.append(f"columns spark={sorted(s_names)} duck={sorted(d_names)}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not problems:
            a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
            if a != b:
                only_s = list((a - b).elements())[:3]
                only_d = list((b - a).elements())[:3]
                problems.append(f"values differ ({sum((a - b).values())} rows)\n  spark-only {only_s}\n  duck-only  {only_d}")
        type_notes = [f"{c}:{s_types[c]}/{d_types.get(c)}" for c in s_names if c in d_types]
        if problems:
            bad += 1
            print(f"FAIL {name} ({ts:.1f}s): " + "; ".join(problems))
            print("   types " + ", ".join(type_notes))
        else:
            print(f"OK   {name}: {len(s_rows)} rows {ts:.1f}s")
    spark.stop()
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
