"""Run registered queries and their SQL side by side and compare the rows.

``python tests/compare.py <folder> [query ...]``
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    have = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if len(want) != len(have):
        return f"{len(have)} rows, expected {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"row {a} != {b}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from courtlake.session import builder

    spark = (
        builder("compare").master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            result = compare(df, con, sql[name]) if name in sql else f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failed += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.2f}s "
              f"{result or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
