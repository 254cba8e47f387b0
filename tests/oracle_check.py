"""Run named queries on Spark and their SQL on DuckDB and compare whole results.

    python tests/oracle_check.py sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_cell(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda row: tuple((v is None, f"{v + 0.0:.3f}" if isinstance(v, float) else str(v)) for v in row))


def differences(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> list[str]:
    """What differs: columns, row count, or values (exactly compared)."""
    left_columns, right_columns = sorted(spark_frame.columns), sorted(oracle_frame.columns)
    if left_columns != right_columns:
        return [f"columns {set(left_columns) ^ set(right_columns)}"]
    if len(spark_frame) != len(oracle_frame):
        return [f"rows {len(spark_frame)} against {len(oracle_frame)}"]
    found = []
    for left, right in zip(rows_of(spark_frame), rows_of(oracle_frame)):
        for name, a, b in zip(left_columns, left, right):
            if a != b or (a == 0 and str(a) != str(b)):
                close = isinstance(a, (int, float)) and isinstance(b, (int, float)) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
                found.append(f"{'~' if close else ''}{name}: {a!r} against {b!r}")
            elif type(a) is not type(b):
                found.append(f"type of {name}: {type(a).__name__} against {type(b).__name__}")
    return found


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from tillwise.catalog.oracles import ORACLES
    from tillwise.catalog.queries import QUERIES

    folder = f"/root/testdata/{sys.argv[1]}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    for name in sys.argv[2:] or QUERIES:
        started = time.time()
        got = QUERIES[name](spark, folder).toPandas()
        spent = time.time() - started
        if name not in ORACLES:
            print(f"{name}: no SQL, {len(got)} rows, {spent:.1f}s")
            continue
        try:
            wanted = connection.execute(ORACLES[name]).df()
        except Exception as error:
            print(f"{name}: SQL ERROR {str(error)[:700]}")
            continue
        found = differences(got, wanted)
        print(f"{name}: {'same' if not found else 'DIFFERENT'}, {len(got)} rows, {spent:.1f}s", flush=True)
        for line in found[:6]:
            print("    ", line)
        if found:
            print("     total", len(found))
