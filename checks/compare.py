"""Run the registered queries and their SQL side by side: python -m checks.compare FOLDER [QUERY ...]."""

import sys
import time

import duckdb
import pandas as pd

from caselode.plans.registry import QUERIES
from caselode.session import local_session
from checks.sql import oracle_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), key=lambda c: c.astype(str)).reset_index(drop=True)


def difference(spark_df, sql_df):
    """None when both hold the same rows, else a short description."""
    a, b = _ordered(spark_df), _ordered(sql_df)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} / {list(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for c in a.columns:
        left, right = a[c].astype(object), b[c].astype(object)
        same = (left == right) | (pd.isna(left) & pd.isna(right))
        if not same.all():
            at = same.idxmin()
            return f"{c}: {(~same).sum()} values, first {left[at]!r} / {right[at]!r}"
        if len(a) and a[c].dtype != b[c].dtype and not a[c].isna().any():
            return f"{c}: type {a[c].dtype} / {b[c].dtype}"
    return None


def main(folder, names):
    spark, con, statements = local_session(), database(folder), oracle_sql()
    for name in names or QUERIES:
        try:
            t = time.time()
            result = QUERIES[name](spark, folder).toPandas()
            took = time.time() - t
            if name not in statements:
                print(f"{name:24s} {took:6.1f}s  no SQL, {len(result)} rows", flush=True)
                continue
            t = time.time()
            wrong = difference(result, con.execute(statements[name]).df())
            print(f"{name:24s} {took:6.1f}s {time.time() - t:6.1f}s {len(result):7d} rows  {wrong or 'same'}", flush=True)
        except Exception as e:  # report and go on with the next query
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
