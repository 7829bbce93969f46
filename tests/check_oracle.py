"""Compares every registered query with its SQL in DuckDB: ``python tests/check_oracle.py [folder] [name …]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
            conversations""".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_by_name(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None when the two results are the same rows under the same column names."""
    ours = driver.queries()[name](spark, folder)
    answer = connection.execute(driver.oracle_sql()[name])
    theirs_names = [column[0] for column in answer.description]
    if sorted(ours.columns) != sorted(theirs_names):
        return f"columns {sorted(ours.columns)} and {sorted(theirs_names)}"
    left = rows_by_name(ours.columns, ours.collect())
    right = rows_by_name(theirs_names, answer.fetchall())
    if left == right:
        return None
    return f"{sum(left.values())} and {sum(right.values())} rows; only ours {list((left - right).items())[:2]}, only SQL {list((right - left).items())[:2]}"


if __name__ == "__main__":
    from conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection, bad = make_session(), duck(folder), 0
    for name in sys.argv[2:] or driver.queries():
        started = time.time()
        try:
            found = difference(spark, connection, folder, name)
        except Exception as error:  # a check run reports every query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - started:.2f}s {found or ''}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or driver.queries())} differ")
