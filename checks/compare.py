"""Runs registered queries and their SQL side by side: `python -m checks.compare [sf] [names]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from checks.oracle_sql import statements
from checks.registry import QUERIES
from tramline.session import local_session


def duckdb_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value: object) -> object:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=repr)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs. Loads both, so test data only."""
    got = rows_of(result.columns, [tuple(row) for row in result.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{mine} instead of {theirs}"
    return None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    folder = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = duckdb_tables(folder), statements(), 0
    for name in names:
        start = time.perf_counter()
        result = QUERIES[name](spark, folder)
        n = result.count() if name not in sql else None
        problem = differences(result, con, sql[name]) if name in sql else f"no SQL, {n} rows"
        failed += bool(problem) and name in sql
        print(f"{name:26} {time.perf_counter() - start:6.2f}s  {problem or 'same'}"[:400], flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
