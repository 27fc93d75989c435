"""Run registered queries beside their SQL and compare every value.

``python tests/oracle_check.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import datetime
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, name, query, sql) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    sql_rows = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    left, right = _bag(df.columns, spark_rows), _bag(columns, sql_rows)
    if left != right:
        only_l, only_r = list((left - right).items())[:2], list((right - left).items())[:2]
        return f"{len(spark_rows)} vs {len(sql_rows)} rows; only spark {only_l}; only sql {only_r}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from strataflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, queries[name], oracle[name]) if name in oracle else "no SQL"
        except Exception as error:  # noqa: BLE001 - reported below
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(sys.argv[2:] or queries)} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
