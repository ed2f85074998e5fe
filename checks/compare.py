"""Run a query in Spark and its SQL twin in DuckDB, and compare all rows.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

from checks.base import QUERIES, SQL


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def rows_of(columns, records) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted(tuple(_cell(r[i]) for i in order) for r in records)
    return [columns[i] for i in order], rows


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None if both engines agree, else what differs."""
    df = QUERIES[name](spark, folder)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(SQL[name])
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    import checks.all  # noqa: F401
    from mendwork import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("checks", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            if name in SQL:
                problem = difference(spark, connection, folder, name)
            else:
                count = len(QUERIES[name](spark, folder).collect())
                problem = None if count else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        note = "" if name in SQL else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name}{note} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
