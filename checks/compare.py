"""Run every registered query in Spark and DuckDB and compare the rows.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.statements import STATEMENTS
from fairwake.plans.catalog import registered_queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


Rows = tuple[list[str], list[tuple]]


def normal(rows: Rows) -> list[tuple[str, ...]]:
    """Columns by name, values as text, rows sorted."""
    names, values = rows
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in values)


def _text(value) -> str:
    if value is None or (isinstance(value, float) and value != value):
        return "NULL"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def differences(actual: Rows, expected: Rows) -> list[str]:
    names = sorted(actual[0])
    if names != sorted(expected[0]):
        return [f"columns: {sorted(set(names) ^ set(expected[0]))}"]
    if len(actual[1]) != len(expected[1]):
        return [f"rows: {len(actual[1])} instead of {len(expected[1])}"]
    off = [(a, b) for a, b in zip(normal(actual), normal(expected)) if a != b]
    if not off:
        return []
    cells = [f"{n}: {x} instead of {y}" for n, x, y in zip(names, *off[0]) if x != y]
    return [f"{len(off)} rows differ; first in {', '.join(cells)}"]


def spark_rows(df: DataFrame) -> Rows:
    return df.columns, [tuple(row) for row in df.collect()]


def duckdb_rows(con: duckdb.DuckDBPyConnection, statement: str) -> Rows:
    result = con.execute(statement)
    return [d[0] for d in result.description], result.fetchall()


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, build in registered_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            actual = spark_rows(build(spark, folder))
            took = time.time() - start
            if name in STATEMENTS:
                found = differences(actual, duckdb_rows(con, STATEMENTS[name]))
            else:
                found = []
        except Exception as problem:  # report and go on with the next query
            actual, took, found = ([], []), time.time() - start, [str(problem)[:600]]
        bad += bool(found)
        note = "; ".join(found) or ("same" if name in STATEMENTS else "no statement")
        print(f"{name:24s} {len(actual[1]):7d} rows {took:6.2f} s  {note}", flush=True)
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
