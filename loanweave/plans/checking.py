"""Compare every registered query with its SQL text on one directory of tables."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "array<string>": "VARCHAR[]",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{directory}/{table}.parquet'")
    return con


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return repr([_key(v) for v in value])
    return repr(value)


def compare(spark: SparkSession, directory: str, function, sql: str) -> str:
    """"ok" with the row count, or what differs."""
    df = function(spark, directory)
    got = [tuple(r) for r in df.collect()]
    con = connect(directory)
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want = relation.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    types = {d[0]: str(d[1]) for d in con.execute(f"describe ({sql})").fetchall() for d in [(d[0], d[1])]}
    wrong = {
        n: (t, types[n]) for n, t in df.dtypes if TYPES.get(t, t).lower() != types[n].lower()
    }
    if wrong:
        return f"types differ: {wrong}"
    order_got = [df.columns.index(n) for n in sorted(names)]
    order_want = [names.index(n) for n in sorted(names)]
    a = sorted(tuple(_key(r[i]) for i in order_got) for r in got)
    b = sorted(tuple(_key(r[i]) for i in order_want) for r in want)
    if len(a) != len(b):
        return f"row counts differ: {len(a)} and {len(b)}"
    for left, right in zip(a, b):
        if left != right:
            diff = [(n, l, r) for n, l, r in zip(sorted(names), left, right) if l != r]
            return f"values differ: {diff[:4]}"
    return f"ok {len(a)}"
