"""Run a registered query and its SQL counterpart on the same tables and compare all values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return 0.0 if value == 0 else (None if math.isnan(value) else float(value))
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected_names, expected = _rows(expected_names, result.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    bad = [(a, b) for a, b in zip(got, expected, strict=True) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, such as {names} {bad[:2]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    connection = connect(folder)
    wanted = sys.argv[2:] or list(entry.queries())
    for key in wanted:
        start = time.time()
        try:
            problem = compare(
                session, connection, folder, entry.queries()[key], entry.oracle_sql()[key]
            )
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{key}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
