"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(
        (tuple(r[i] for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r]
    )


def compare(spark, con, query, sql, sf_dir):
    got = query(spark, sf_dir)
    left = rows_of(got.columns, [tuple(r) for r in got.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    right = rows_of(names, result.fetchall())
    return left, right
