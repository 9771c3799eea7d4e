"""Runs registered queries and their SQL on the same files and compares the results.

`python tests/oracle.py SF_DIR [query ...]` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def spark_session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(value) + 0.0)
    if isinstance(value, bool):
        return repr(value)
    if isinstance(value, int):
        return repr(float(value))
    return repr(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    got_columns, got = df.columns, rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(got_columns) != sorted(columns):
        return f"columns {sorted(got_columns)} instead of {sorted(columns)}"
    if not want:
        return "the SQL gives no rows"
    extra, lacking = got - want, want - got
    if extra or lacking:
        return (
            f"{sum(extra.values())} rows too many, {sum(lacking.values())} missing; "
            f"e.g. {next(iter(extra), None)} / {next(iter(lacking), None)}"
        )
    return None


def main(sf_dir: str, *names: str) -> None:
    import __spark_entry__ as entry

    spark = spark_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            outcome = compare(df, con, oracle[name]) if name in oracle else f"{df.count()} rows, no SQL"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.time() - start:6.1f}s  {outcome or 'equal'}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
