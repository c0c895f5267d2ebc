"""Compare a query with its SQL on the same parquet files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{Path(sf_dir) / name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: [(c is not None, str(type(c)), str(c)) for c in r])


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted([tuple(_cell(r[n]) for n in names) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    names = sorted(cols)
    order = [cols.index(n) for n in names]
    return names, _sorted([tuple(_cell(r[i]) for i in order) for r in cur.fetchall()])


def difference(df, con, sql) -> str | None:
    names, ours = spark_rows(df)
    expected, theirs = sql_rows(con, sql)
    if names != expected:
        return f"columns {names} != {expected}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{names}: {str(a)[:600]} != {str(b)[:600]}"
        for x, y in zip(a, b):
            if type(x) is not type(y):
                return f"types {names}: {a} {b}"
    return None


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(c is None, str(c)) for c in r])
