"""Compares a query with its SQL, as the driver does."""

import glob
import os

import duckdb

SMALL = "/root/testdata/sf0.001"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, type(None))) else str(v)
    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir=SMALL):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def same(spark, con, query, sql, sf_dir=SMALL):
    df = query(spark, sf_dir)
    found = con.execute(sql)
    assert normal(df.columns, df.collect()) == normal([d[0] for d in found.description], found.fetchall())
