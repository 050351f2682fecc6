"""Compare registered queries with their SQL counterparts: row counts, column names, values."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql) -> str:
    """Empty if both sides agree."""
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    expected = rows_of(expected_columns, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected, strict=True) if g != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries

    from candlewick import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf)
    for name in names:
        start = time.time()
        try:
            found = difference(queries()[name](spark, sf), connection, oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s {found}", flush=True)
