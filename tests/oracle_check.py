"""Run every query against its check SQL in DuckDB: python -m tests.oracle_check [sf_dir] [name ...]

With NO_BROADCAST=1 no table is small enough to broadcast, so every lookup takes the salted shuffle join.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries
from ledgerlark.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides give the same columns and the same values, otherwise the first difference."""
    df = queries()[name](spark, sf_dir)
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    result = con.execute(oracle_sql()[name])
    want_columns, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    got, want = sorted_rows(got_columns, got), sorted_rows(want_columns, want)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if got == want:
        return None
    extra, missing = [r for r in got if r not in want][:3], [r for r in want if r not in got][:3]
    return f"{sorted(got_columns)}: got {extra}, expected {missing}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if os.environ.get("NO_BROADCAST") else {}
    spark, con, failed = local_session(8, **conf), open_tables(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                verdict = compare(spark, con, name, sf_dir)
            else:
                verdict = None if queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        failed += verdict is not None
        print(f"{time.time() - start:6.2f}s  {name:32s} {'ok' if verdict is None else 'FAIL ' + verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
