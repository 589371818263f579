"""Runs registered queries beside their oracle SQL and compares the rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, int):
        return (2, repr(float(value)))
    if isinstance(value, float):
        return (2, repr(value + 0.0))
    return (3, str(value))


def _sorted_rows(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def difference(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    mine = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)}"
    left, right = _sorted_rows(df.columns, mine), _sorted_rows(names, theirs)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if not wrong:
        return None
    a, b = wrong[0]
    cells = [(n, x[1], y[1]) for n, x, y in zip(sorted(names), a, b) if x != y]
    return f"{len(wrong)} of {len(mine)} rows differ, first {cells[:5]}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = e.queries(), e.oracle_sql()
    bad = 0
    for name in args or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem = difference(df, con, oracle[name])
                verdict = "ok" if problem is None else f"DIFFERS: {problem}"
            else:
                verdict = f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += verdict.startswith(("DIFFERS", "ERROR"))
        print(f"{name:28} {time.time() - start:6.1f}s  {verdict}", flush=True)
    print(f"{bad} not right")


if __name__ == "__main__":
    main()
