"""Compare a query with its SQL on the same files, value by value."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, relation):
    """None if equal, else what differs."""
    columns, expected_columns = df.columns, relation.columns
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} != {sorted(expected_columns)}"
    found = rows_of(columns, (tuple(r) for r in df.collect()))
    expected = rows_of(expected_columns, relation.fetchall())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{found.total()} rows vs {expected.total()}; {extra.total()} extra such as "
        f"{list(extra)[:2]}; {missing.total()} missing such as {list(missing)[:2]}"
    )
