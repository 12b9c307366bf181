"""Run registered queries in Spark and DuckDB and compare them value by value.

Usage: python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

from tillroll.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v if isinstance(v, (str, bool, type(None))) else str(v)


def _kind(v) -> str:
    return type(v).__name__


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def difference(frame, db, sql: str) -> str | None:
    """None when columns, row count, types and values agree."""
    rows = [tuple(r) for r in frame.collect()]
    answer = db.execute(sql)
    columns = [d[0] for d in answer.description]
    expected = answer.fetchall()
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    at = {c: i for i, c in enumerate(columns)}
    for i, c in enumerate(frame.columns):
        mine = {_kind(r[i]) for r in rows} - {"NoneType"}
        theirs = {_kind(r[at[c]]) for r in expected} - {"NoneType"}
        if mine != theirs:
            return f"{c}: {mine} != {theirs}"
    a, b = normalised(frame.columns, rows), normalised(columns, expected)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, db, failed = local_session(), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in oracle:
                problem = difference(frame, db, oracle[name])
                note = "ok" if problem is None else f"FAIL {problem}"
            else:
                problem, note = None, f"rows only: {len(frame.collect())}"
        except Exception as error:  # report and go on with the next query
            problem = note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
