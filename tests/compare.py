"""Run the named queries and their oracle SQL side by side: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_DATA", "/root/testdata")


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normalized(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in order."""
    df = df[sorted(df.columns)].astype(object)
    return df.map(_text).sort_values(list(df.columns)).reset_index(drop=True)


def _text(value: object) -> str:
    if value is None or value is pd.NA or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        number = float(value) + 0.0
        return repr(0.0 if number == 0 else number)
    return str(value)


def difference(spark_rows: pd.DataFrame, oracle_rows: pd.DataFrame) -> str:
    """Empty when both hold the same rows."""
    if sorted(spark_rows.columns) != sorted(oracle_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(oracle_rows.columns)}"
    if len(spark_rows) != len(oracle_rows):
        return f"rows {len(spark_rows)} / {len(oracle_rows)}"
    a, b = normalized(spark_rows), normalized(oracle_rows)
    if a.equals(b):
        return ""
    where = (a != b).any(axis=1)
    return f"{int(where.sum())} rows differ, first:\n{a[where].head(3).to_string()}\n{b[where].head(3).to_string()}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import session

    spark = session()
    folder = f"{DATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    con = oracle_connection(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            rows = run(spark, folder).toPandas()
            took = time.time() - start
            found = difference(rows, con.execute(sql[name]).df()) if name in sql else "no oracle"
        except Exception as error:  # report and go on with the next query
            took, rows, found = time.time() - start, [], f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{name:36s} {took:6.2f}s {len(rows):7d} rows  {found or 'equal'}", flush=True)
    print(f"{bad} not equal")
