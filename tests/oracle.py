"""Compare named queries with their SQL twins in DuckDB.

Run as ``python -m tests.oracle FOLDER [name ...]`` from the repository root.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession


def make_spark() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("shelfpair-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, name: str, fn, sql: str, folder: str) -> tuple[bool, str]:
    df = fn(spark, folder)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return False, f"rows {sum(got.values())} vs {sum(want.values())}\n   only spark {extra}\n   only sql   {missing}"
    return True, f"{sum(got.values())} rows"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    spark, con, bad = make_spark(), connect(folder), 0
    for name in names or sorted(queries):
        start = time.time()
        try:
            if name in oracles:
                ok, note = compare(spark, con, name, queries[name], oracles[name], folder)
            else:
                ok, note = True, f"{len(queries[name](spark, folder).collect())} rows, no SQL twin"
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
