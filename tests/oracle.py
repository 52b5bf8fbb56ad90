"""Run every query on Spark and its SQL on DuckDB and compare whole results.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None when both results are equal, else what differs."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    # pandas holds longs with NULLs as floats, DuckDB as nullable integers
    for column in sql_rows.columns[[str(t) == "Int64" for t in sql_rows.dtypes]]:
        spark_rows = spark_rows.astype({column: "Int64"})
    left, right = normal(spark_rows), normal(sql_rows)
    types = [(c, str(left[c].dtype), str(right[c].dtype)) for c in left if left[c].dtype != right[c].dtype]
    if types:
        return f"types {types}"
    for column in left:
        same = (left[column] == right[column]) | (left[column].isna() & right[column].isna())
        if not same.all():
            at = same.idxmin()
            return f"{column}: {(~same).sum()} differ, first {left[column][at]!r} / {right[column][at]!r}"[:600]
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, con, failed = make_session(), connect(folder), 0
    for name in names:
        began = time.time()
        try:
            rows = queries()[name](spark, folder).toPandas()
            took = time.time() - began
            sql = oracle_sql().get(name)
            found = difference(rows, con.sql(sql).df()) if sql else "no sql"
        except Exception as error:  # report and go on with the next query
            took, found = time.time() - began, f"{type(error).__name__}: {str(error)[:700]}"
        failed += found is not None
        print(f"{name:22s} {took:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
