"""Runs registered queries beside their SQL counterparts and compares the results.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracles import ORACLES
from quotidian.registry import QUERIES
from quotidian.session import local_session
from quotidian.sources.warehouse import TABLES


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return value


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark, con, name: str, folder: str) -> tuple[str | None, int, float, float]:
    """(difference or None, rows, Spark seconds, SQL seconds)."""
    start = time.time()
    df = QUERIES[name](spark, folder)
    ours = df.collect()
    spark_seconds = time.time() - start
    if name not in ORACLES:
        return None, len(ours), spark_seconds, 0.0

    start = time.time()
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    sql_seconds = time.time() - start

    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(ours), spark_seconds, sql_seconds
    a, b = normal_rows(df.columns, ours), normal_rows(columns, theirs)
    difference = None
    if len(a) != len(b):
        difference = f"{len(a)} rows != {len(b)} rows"
    elif a != b:
        wrong = [(x, y) for x, y in zip(a, b) if x != y]
        difference = f"{len(wrong)} rows differ, first {wrong[0]}"
    return difference, len(ours), spark_seconds, sql_seconds


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = open_tables(folder)
    bad = 0
    for name in names:
        try:
            difference, rows, ours, theirs = differences(spark, con, name, folder)
        except Exception as exc:  # the list goes on; the failure is reported
            difference, rows, ours, theirs = f"{type(exc).__name__}: {str(exc)[:600]}", 0, 0.0, 0.0
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {name:34} {rows:8} rows "
              f"spark {ours:6.2f}s sql {theirs:6.2f}s {difference or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
