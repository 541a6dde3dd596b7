"""Rows of a query against rows of its SQL in DuckDB, whatever their order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    found = duckdb.connect()
    for name in TABLES:
        found.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return found


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(found) -> Counter:
    return Counter(plain(tuple(r)) for r in found)


def check(frame, sql: str, sf_dir: str) -> None:
    columns = sorted(frame.columns)
    relation = duck(sf_dir).sql(sql)
    assert sorted(relation.columns) == columns
    expected = relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert rows(frame.select(*columns).collect()) == rows(expected)
