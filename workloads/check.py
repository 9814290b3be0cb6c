"""Compare registered queries with their SQL: ``python -m workloads.check [folder] [name …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from matchlens.session import build_session
from workloads.oracle import ORACLE
from workloads.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple[str, ...]]]:
    names = sorted(df.columns)
    return names, sorted(tuple(map(plain, row)) for row in df.select(*names).collect())


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = sorted(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [columns[i] for i in order], found


def compare(spark, connection, folder: str, name: str) -> str | None:
    """Difference between a query and its SQL, None where they agree."""
    names, rows = spark_rows(QUERIES[name](spark, folder))
    if name not in ORACLE:
        return None if rows else "no rows"
    expected_names, expected = sql_rows(connection, ORACLE[name])
    if names != expected_names:
        return f"columns {names} and {expected_names}"
    if not rows:
        return "no rows"
    if rows != expected:
        extra, missing = sorted(set(rows) - set(expected))[:2], sorted(set(expected) - set(rows))[:2]
        return f"{len(rows)} and {len(expected)} rows; only Spark {extra}; only SQL {missing}"
    return None


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = build_session("check", "local[8]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in arguments[1:] or QUERIES:
        start = time.time()
        try:
            difference = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += difference is not None
        print(f"{name}: {difference or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
