"""Run queries next to their SQL: python tests/compare.py [sf_dir] [name ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


TYPES = {
    "VARCHAR": {"string"}, "INTEGER": {"int"}, "BIGINT": {"bigint"}, "DOUBLE": {"double"}, "BOOLEAN": {"boolean"},
    "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def canonical(columns, rows):
    """Columns by name, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf, name, run, sql):
    """A word on the difference, empty if there is none, and the number of rows."""
    df = run(spark, sf)
    columns, rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "", len(rows)
    result = con.sql(sql)
    other, expected = canonical(result.columns, result.fetchall())
    if columns != other:
        return f"columns {columns} != {other}", len(rows)
    kinds = dict(zip(result.columns, map(str, result.types)))
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if t not in TYPES.get(kinds[c], {t})}
    if wrong:
        return f"types differ: {wrong}", len(rows)
    if rows != expected:
        extra = sorted(set(rows) - set(expected), key=repr)[:3]
        missing = sorted(set(expected) - set(rows), key=repr)[:3]
        return f"{len(rows)} != {len(expected)} rows, extra {extra}, missing {missing}", len(rows)
    return "", len(rows)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            word, n = compare(spark, con, sf, name, run, oracle_sql().get(name))
        except Exception as error:
            word, n = repr(error)[:1500], -1
        print(f"{'ok  ' if not word else 'BAD '} {name} rows={n} {time.time() - start:.1f}s {word}", flush=True)
