"""Compare a registered query with its SQL counterpart, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def differences(df, connection, sql: str) -> str | None:
    """What differs, or None. Values must be equal exactly; row order does not count."""
    names = sorted(df.columns)
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} but {sorted(relation.columns)}"
    mine = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    at = [relation.columns.index(n) for n in names]
    theirs = [tuple(_plain(row[i]) for i in at) for row in relation.fetchall()]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    mine.sort(key=key)
    theirs.sort(key=key)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows but {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, e.g. {wrong[0]}" if wrong else None
