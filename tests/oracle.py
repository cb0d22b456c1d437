"""Run registered queries and compare them with their check SQL in DuckDB.

Usage: python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plain(value):
    """A value in the form in which both engines must agree."""
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r),
    )


def duck(folder: str):
    import duckdb

    from vacantia.workloads.base import TABLES

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder: str, name: str):
    """(status, seconds, detail) of one query."""
    from vacantia.workloads import CHECKS, QUERIES

    started = time.time()
    frame = QUERIES[name](spark, folder)
    got = frame.collect()
    seconds = time.time() - started
    if name not in CHECKS:
        return "rows", seconds, f"{len(got)} rows"
    result = con.execute(CHECKS[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return "FAIL", seconds, f"columns {sorted(frame.columns)} / {sorted(columns)}"
    left, right = rows_of(frame.columns, got), rows_of(columns, want)
    if left == right:
        return "ok", seconds, f"{len(got)} rows"
    diff_left = [r for r in left if r not in set(right)][:2]
    diff_right = [r for r in right if r not in set(left)][:2]
    return "FAIL", seconds, f"{len(left)}/{len(right)} rows\n   spark {diff_left}\n   duck  {diff_right}"[:1500]


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from vacantia import build_session
    from vacantia.workloads import QUERIES

    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = []
    for name in [n for n in QUERIES if not args.names or any(a in n for a in args.names)]:
        try:
            status, seconds, detail = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the others
            status, seconds, detail = "ERROR", 0.0, f"{type(error).__name__}: {str(error)[:900]}"
        if status in ("FAIL", "ERROR"):
            failed.append(name)
        print(f"{status:5} {seconds:6.2f}s {name}: {detail}", flush=True)
    print("failed:", failed or "none")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
