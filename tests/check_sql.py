"""Run registered queries beside their check SQL: python tests/check_sql.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    return "null" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str, run, sql: str | None) -> str:
    started = time.time()
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    took = time.time() - started
    if sql is None:
        return f"{name}: {len(got)} rows, no check SQL ({took:.1f}s)"
    result = con.sql(sql)
    if sorted(result.columns) != sorted(df.columns):
        return f"{name}: COLUMNS DIFFER {sorted(set(result.columns) ^ set(df.columns))}"
    want = rows_of(result.columns, result.fetchall())
    if got == want:
        return f"{name}: ok, {len(got)} rows ({took:.1f}s)" + ("" if got else " EMPTY")
    extra, missing = [r for r in got if r not in want][:2], [r for r in want if r not in got][:2]
    return f"{name}: VALUES DIFFER {len(got)} vs {len(want)} rows ({took:.1f}s)\n  spark: {extra}\n  sql:   {missing}\n  columns: {sorted(df.columns)}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, con, sf_dir, name, run, sqls.get(name))
        except Exception as error:  # report every query, then fail
            line = f"{name}: ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += "DIFFER" in line or "ERROR" in line or "EMPTY" in line
        print(line, flush=True)
    print(f"{bad} bad")
    return min(bad, 1)


if __name__ == "__main__":
    raise SystemExit(main())
