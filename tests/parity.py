"""Rows of a query beside rows of its SQL, as sorted text."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def engine(folder):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _text(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(list(v)) if hasattr(v, "__len__") and not isinstance(v, (str, bytes)) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(_text, r)) for r in df.itertuples(index=False))


def same(spark_df, con, sql):
    mine, theirs = spark_df.toPandas(), con.execute(sql).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)
