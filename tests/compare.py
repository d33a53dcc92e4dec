"""Comparison of a query with its oracle: columns by name, rows as a multiset."""

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None if equal, else a description."""
    cur = con.execute(sql)
    oracle_columns = [d[0] for d in cur.description]
    if sorted(oracle_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(oracle_columns)}"
    want = _rows(oracle_columns, cur.fetchall())
    got = _rows(df.columns, df.collect())
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows, oracle {sum(want.values())}; "
        f"only in query {sum(extra.values())}: {list(extra)[:3]}; "
        f"only in oracle {sum(missing.values())}: {list(missing)[:3]}"
    )
