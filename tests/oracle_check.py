"""Compare registered queries with their SQL twins. Run as a script for a report."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides have the same columns, rows and values."""
    mine = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    other = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    wrong = [(a, b) for a, b in zip(mine, other) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    from filmdw.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "check",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, texts = connect(sf_dir), contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in texts:
                found = difference(query(spark, sf_dir), con, texts[name])
            else:
                found = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {found or 'ok'}", flush=True)
    print("failed:", failed)
