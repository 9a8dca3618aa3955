"""Spark result against SQL result, as multisets of rows."""

import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(frame, con, sql):
    """An empty list if both give the same columns and rows."""
    found = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in found.description], found.fetchall())
    have_columns, have = rows_of(frame.columns, frame.collect())
    if have_columns != want_columns:
        return [f"columns {have_columns} != {want_columns}"]
    out = []
    if have != want:
        out.append(f"rows {sum(have.values())} / {sum(want.values())}")
        out += [f"only spark {r}" for r in list((have - want))[:3]] + [f"only sql {r}" for r in list((want - have))[:3]]
    return out
