"""Compare registered queries with their SQL, run by DuckDB on the same files.

    python tests/oracle.py <folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_value(row[i]) for i in order) for row in rows),
        key=lambda row: [(v is None, str(type(v)), v) for v in row],
    )


def differences(df, connection, sql: str) -> str | None:
    """What differs between a frame and a SQL result, or None."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, spark_type in df.dtypes:
        if _SAME_TYPE.get(spark_type, spark_type) != types[name]:
            return f"type of {name}: {spark_type} != {types[name]}"
    actual = _rows([tuple(r) for r in df.collect()], df.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{dict(zip(sorted(names), a))} != {dict(zip(sorted(names), e))}"
    return None


def main(folder: str, wanted: list[str]) -> int:
    from shopgrain.registry import oracle_sql, queries
    from shopgrain.session import build_session

    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sql = oracle_sql()
    failed = 0
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sql:
                problem = differences(df, connection, sql[name])
                rows = len(df.take(1))
                note = "" if rows else " (no rows)"
            else:
                note, problem = f" (no SQL, {df.count()} rows)", None
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.1f}s{note} {problem or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
