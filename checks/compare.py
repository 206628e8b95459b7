"""Compare registered queries with their SQL: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, float):
        return repr(float(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_text(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, folder: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLE[name])
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {sorted(set(ours[0]) ^ set(theirs[0]))}"
    if not ours[1]:
        return "no rows"
    if ours[1] == theirs[1]:
        return None
    a, b = set(ours[1]), set(theirs[1])
    only = sorted(a - b)[:2], sorted(b - a)[:2]
    return f"{len(ours[1])} against {len(theirs[1])} rows; only here {only[0]}; only there {only[1]}; {ours[0]}"


def main() -> int:
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder) if name in ORACLE else "no SQL"
        except Exception as error:  # the list goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
