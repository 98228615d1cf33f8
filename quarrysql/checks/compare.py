"""Runs registered queries next to their SQL and compares the rows. For tests and local checks only."""

from __future__ import annotations

import datetime
import decimal
import math
import time

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _kind(v) -> str:
    return type(v).__name__


def difference(spark: SparkSession, con, sf_dir: str, query, sql: str | None) -> tuple[str | None, int, float]:
    """``(what differs or None, rows, seconds)``."""
    start = time.time()
    df = query(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    seconds = time.time() - start
    if sql is None:
        return (None if got else "no rows"), len(got), seconds
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}", len(got), seconds
    want = _rows(names, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows <> {len(want)}", len(got), seconds
    for a, b in zip(got, want, strict=True):
        if a != b or [_kind(x) for x in a] != [_kind(x) for x in b]:
            return f"{a} <> {b}", len(got), seconds
    return None, len(got), seconds
