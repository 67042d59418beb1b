"""Order-insensitive comparison of a Spark result with a DuckDB one."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES_DIR = os.environ.get("ISOBAR_TESTDATA", "/root/testdata/sf0.001")


def connect(sf_dir: str = TABLES_DIR) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark_df, connection, sql: str) -> list[str]:
    relation = connection.execute(sql)
    expected_columns = [d[0] for d in relation.description]
    expected_types = {d[0]: str(d[1]) for d in relation.description}
    expected = normal(expected_columns, relation.fetchall())
    actual = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sorted(expected_columns) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} expected {sorted(expected_columns)}")
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP"}
    for name, kind in spark_df.dtypes:
        if names.get(kind) != expected_types.get(name):
            found.append(f"type of {name}: {kind} expected {expected_types.get(name)}")
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows, expected {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
