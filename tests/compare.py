"""Run registered queries and their SQL on the same tables and compare the rows.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

import math
import pathlib
import sys
import time
from collections import Counter

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """(equal, Spark rows, message)"""
    df = query(spark, sf_dir)
    got_columns, got = bag(df.columns, df.collect())
    if sql is None:
        return True, sum(got.values()), "no SQL"
    answer = con.sql(sql)
    columns, expected = bag(answer.columns, answer.fetchall())
    if got_columns != columns:
        return False, sum(got.values()), f"columns {got_columns} / {columns}"
    if got != expected:
        extra, missing = list((got - expected).items())[:3], list((expected - got).items())[:3]
        return False, sum(got.values()), f"{sum(expected.values())} expected; only Spark: {extra}; only SQL: {missing}"
    return True, sum(got.values()), ""


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    wrong = 0
    for name in names:
        start = time.time()
        try:
            equal, n, message = compare(spark, con, sf_dir, name, entry.queries()[name], entry.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001
            equal, n, message = False, -1, f"{type(error).__name__}: {str(error)[:600]}"
        wrong += not equal
        print(f"{'ok  ' if equal else 'DIFF'} {name} rows={n} {time.time() - start:.1f}s {message[:1500]}", flush=True)
    print(f"{len(names) - wrong} of {len(names)} equal")
    spark.stop()
    sys.exit(wrong > 0)


if __name__ == "__main__":
    main()
