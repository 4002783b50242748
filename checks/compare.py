"""Run registered queries and their SQL side by side on one test folder.

``python -m checks.compare [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd

from accountpulse.session import build_session

from .oracle import ORACLE
from .registry import QUERIES


# Digits that floating-point results must share; ``COMPARE_DIGITS=17`` asks for all of them.
DIGITS = int(os.environ.get("COMPARE_DIGITS", "9"))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return f"{value:.{DIGITS}g}"
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def rows_of(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both results are the same, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(set(columns) ^ set(spark_df.columns))}"
    theirs = rows_of(columns, result.fetchall())
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(ours) != len(theirs):
        return f"rows {len(ours)} against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row {a} against {b}"[:600]
    return None


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("COMPARE_PARTITIONS", "8"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            problem = differences(df, con, ORACLE[name]) if name in ORACLE else f"no SQL, {df.count()} rows"
        except Exception as exc:
            problem = f"{type(exc).__name__}: {exc}"[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} problems")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
