"""Run a query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    if isinstance(value, datetime):
        return value
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, statement):
    cursor = con.execute(statement)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


FAMILY = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int"}


def difference(df, con, statement) -> str | None:
    columns, ours = spark_rows(df)
    sql_columns, theirs = sql_rows(con, statement)
    if columns != sql_columns:
        return f"columns {columns} against {sql_columns}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{columns}\n  spark {a}\n  sql   {b}"
        kinds = [(type(x), type(y)) for x, y in zip(a, b, strict=True) if x is not None]
        odd = [k for k in kinds if k[0] is not k[1]]
        if odd:
            return f"types differ {odd} in {columns}"
    return None
