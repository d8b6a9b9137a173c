"""Compare every query with its SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem documents benchmark labels conversations".split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if rows, columns and types agree, else what differs."""
    frame = entry.queries()[name](spark, folder)
    result = con.execute(entry.oracle_sql()[name])
    theirs = {d[0]: str(d[1]).upper() for d in result.description}
    ours = {c: TYPES[t] for c, t in frame.dtypes}
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    columns = sorted(ours)
    order = [d[0] for d in result.description]
    left = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
    positions = [order.index(c) for c in columns]
    right = sorted((tuple(row[p] for p in positions) for row in result.fetchall()), key=repr)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    if not left:
        return "no rows"
    for mine, other in zip(left, right):
        if mine != other:
            return f"{mine} != {other}"[:600]
    return None


if __name__ == "__main__":
    from conftest import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(folder)
    failed = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problem = compare(spark, con, folder, name)
            else:
                problem = None if entry.queries()[name](spark, folder).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    sys.exit(failed)
