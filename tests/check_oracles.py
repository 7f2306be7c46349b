"""Run registered queries next to their SQL and compare all rows: ``check_oracles.py sf [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["events", "lineitem", "orders", "part", "documents", "conversations"]


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
        result = db.execute(sql)
        return [c[0] for c in result.description], result.fetchall()


def compare(spark, query, sql: str, sf_dir: str) -> tuple[int, str]:
    """Number of rows, and what differs ('' if nothing does)."""
    df = query(spark, sf_dir)
    columns, expected = sql_rows(sf_dir, sql)
    if sorted(df.columns) != sorted(columns):
        return 0, f"columns {df.columns} against {columns}"
    got = sorted(tuple(row[c] for c in sorted(columns)) for row in df.collect())
    by_name = [columns.index(c) for c in sorted(columns)]
    want = sorted(tuple(row[i] for i in by_name) for row in expected)
    if len(got) != len(want):
        return len(got), f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return len(got), f"{g} against {w}"
    return len(got), ""


def main() -> int:
    import __spark_entry__ as entry_points
    from tests.conftest import session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    queries, sqls = entry_points.queries(), entry_points.oracle_sql()
    spark, failed = session(), 0
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            rows, difference = compare(spark, queries[name], sqls[name], sf_dir)
        except Exception as error:
            rows, difference = 0, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{name:34} {rows:8} rows {time.time() - began:6.1f} s  {difference or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
