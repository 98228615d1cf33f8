"""Sharding by a Feistel permutation of global row numbers.

Row number x goes to place p(x), p a keyed permutation of 0 .. n - 1; the shard is p mod shards, the slot is
p div shards. So shards differ by one row at most, slots have no gaps, the same rows and seed give the same
places, and the row number of any shard and slot can be computed without data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import numbered, text_of

ROUNDS = 8
SEED = 20_240_601


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rounds(x: np.ndarray, half: int, keys: np.ndarray, back: bool) -> np.ndarray:
    """The network over two halves of ``half`` bits, or its inverse."""
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> shift, x & mask
    if back:
        for key in keys[::-1]:
            left, right = right ^ (_mix(left ^ key) & mask), left
    else:
        for key in keys:
            left, right = right, left ^ (_mix(right ^ key) & mask)
    return (left << shift) | right


def permuted(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Places of the row numbers among ``n`` (or, ``back``, the row numbers of places).

    The network permutes the next power of four; a result of n or more is sent through again until it is
    below n (cycle walking), at most four times on average.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out = _rounds(np.asarray(numbers, np.uint64), half, keys, back)
    while len(over := np.flatnonzero(out >= np.uint64(n))):
        out[over] = _rounds(out[over], half, keys, back)
    return out.astype(np.int64)


def row_number_at(shard: int, slot: int, shards: int, n: int, seed: int = SEED) -> int:
    """The global row number that lies in a slot of a shard."""
    return int(permuted(np.array([slot * shards + shard]), n, seed, back=True)[0])


def place(number: str, n: int, seed: int = SEED) -> Column:
    """The place of each row number, computed in Arrow batches."""

    def run(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, seed))

    run.__annotations__ = {"numbers": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "long")(F.col(number))


def sharded(df: DataFrame, order: list[str], shards: int, seed: int = SEED) -> DataFrame:
    """The rows of ``df`` as a struct ``row``, with ``number``, ``shard`` and ``slot``.

    Row numbers follow ``order``, nulls first, then all other columns; equal rows get numbers of their own,
    and which of them gets which makes no difference. An empty table gives an empty result. The columns of
    ``df`` stay inside ``row`` and may have any names; they must be of types that can be sorted.
    """
    rows, n = numbered(df, order, "shard-rows")
    placed = rows.withColumn("p", place("number", n, seed))
    return placed.select("row", "number", (F.col("p") % shards).cast("int").alias("shard"), F.floor(F.col("p") / shards).cast("long").alias("slot"))


def write_shards(df: DataFrame, order: list[str], shards: int, path: str, seed: int = SEED) -> None:
    """Writes whole rows to one folder for each shard, each row with its slot; a shard's files need no order."""
    out = sharded(df, order, shards, seed)
    taken = {c for c in df.columns if c in ("shard", "slot")}
    out.select("shard", "slot", *[F.col("row")[c].alias(f"{c}_in" if c in taken else c) for c in df.columns]).write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard and slot of each row under the law ``rows``: counts of shards are at most one apart.

    A null text counts no bytes and has the crc32 of the empty text. Null and repeated ids are rows like
    others. Other columns are ignored. Long texts count whole. An empty table gives an empty result.
    """
    text = text_of().cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text_of()).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    return sharded(rows, ["doc_id"], shards).select(
        "row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
