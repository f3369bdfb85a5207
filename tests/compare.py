"""Strict comparison of a Spark result with DuckDB's answer to the twin SQL."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs: column names and types first, then rows as a multiset."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    duck = {r[0]: r[1] for r in described}
    spark = {name: SPARK_TO_DUCK.get(kind, kind) for name, kind in df.dtypes}
    if duck != spark:
        return [f"schema: spark {sorted(spark.items())} duckdb {sorted(duck.items())}"]
    columns = sorted(spark)
    theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({sql}) t").fetchall()
    ours = df.select(columns).collect()
    a = Counter(tuple(map(_cell, r)) for r in ours)
    b = Counter(tuple(map(_cell, r)) for r in theirs)
    found = []
    if len(ours) != len(theirs):
        found.append(f"rows: spark {len(ours)} duckdb {len(theirs)}")
    if a != b:
        found.append(f"only spark {list((a - b).items())[:3]} only duckdb {list((b - a).items())[:3]}")
    return found
