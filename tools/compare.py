"""Run registered queries and their SQL side by side: ``python tools/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.plans.oracle import ORACLE  # noqa: E402
from tablewright.plans.queries import QUERIES  # noqa: E402
from tablewright.session import build_session  # noqa: E402


def _cell(value: object) -> object:
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.6g}" if abs(value) < 1e-3 else f"{value:.4f}")
    if isinstance(value, int):
        return (1, str(value))
    return (1, str(value))


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None if Spark and DuckDB agree on columns and rows, else what differs first."""
    result = QUERIES[name](spark, sf_dir)
    got = [tuple(row) for row in result.collect()]
    if name not in ORACLE:
        return None
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns: {sorted(result.columns)} against {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    wrong = [c for c, k in kinds.items() if "HUGEINT" in k or "DECIMAL" in k]
    if wrong:
        return f"SQL types without a Spark counterpart: {wrong}"
    want = cursor.fetchall()
    if len(got) != len(want):
        return f"rows: {len(got)} against {len(want)}"
    for a, b in zip(_rows(result.columns, got), _rows(columns, want)):
        if a != b:
            return f"first difference:\n  {a}\n  {b}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:7.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
