"""Compare every query with its SQL oracle: ``python tools/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagemill.session import local_session  # noqa: E402
from pagemill.suite import ORACLES, QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def cell(value) -> str:
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def compare(spark, connection, name: str, sf_dir: str, result=None) -> tuple[str, float]:
    start = time.time()
    result = QUERIES[name](spark, sf_dir) if result is None else result
    rows = [tuple(r) for r in result.collect()]
    seconds = time.time() - start
    if name not in ORACLES:
        return f"rows {len(rows)}", seconds
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(result.columns):
        return f"FAIL columns {sorted(result.columns)} / {sorted(columns)}", seconds
    ours, theirs = normal(result.columns, rows), normal(columns, expected)
    if ours == theirs:
        return f"ok {len(rows)}", seconds
    only = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
    return f"FAIL {len(ours)}/{len(theirs)} rows, ours {str(only[0])[:600]} theirs {str(only[1])[:600]}", seconds


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(8), oracle(sf_dir)
    bad = 0
    for name in names:
        try:
            verdict, seconds = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            verdict, seconds = f"FAIL {type(error).__name__}: {str(error)[:900]}", 0.0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += verdict.startswith("FAIL")
        print(f"{name:24s} {seconds:6.2f}s {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
