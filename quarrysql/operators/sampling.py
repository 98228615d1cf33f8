"""Exact-size samples, rebalancing, shuffling and splits.

A sample of ``n`` rows is the ``n`` smallest by hash (or by order) of a unique id. Narrow rows of ids are written once, and the n-th
of them is found by counting: the range of their numbers is cut into slices, and the slice that holds the n-th is
cut again, until few rows are left to sort. So neither an outlier nor ids in clusters leave a task with many rows. The
wide rows are only compared with the n-th id, never sorted or moved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrysql.functions.text import hash_bucket, hash_hex
from quarrysql.session import written

#: Slices of a range, which is also how many counts the driver sees at a time, and rows that one task may sort.
SLICES, FEW = 4_096, 10_000


Quota = Callable[[Column, Column], Column]


def _nth(ids: DataFrame, n: int, order: list[str]) -> Row | None:
    """The ``n``-th row by ``order``, whose first column is a number; None if there are fewer rows, or n is not positive."""
    key = F.col(order[0])
    ends = ids.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if not 0 < n <= ends.n:
        return None
    lo, hi, before, held = ends.lo, ends.hi, 0, ends.n
    while held > FEW and lo < hi:
        width = -(-(hi - lo + 1) // SLICES)
        # Differences of two 64-bit numbers need not fit into one.
        offset = key.cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)") if hi - lo >= 2**63 else key - F.lit(lo)
        slices = ids.where(key.between(lo, hi)).groupBy(F.floor(offset / F.lit(width)).cast("int").alias("slice")).agg(F.count(F.lit(1)).alias("n"))
        for found in sorted(slices.collect()):
            if before + found.n >= n:
                break
            before += found.n
        lo, hi, held = lo + found.slice * width, min(hi, lo + (found.slice + 1) * width - 1), found.n
    return ids.where(key.between(lo, hi)).orderBy(*order).limit(n - before).orderBy(*[F.desc(c) for c in order]).first()


def _id(df: DataFrame, id_col: str) -> Column:
    """An id as a number; other ids, a struct of path and place say, as the number of their hash."""
    numeric = isinstance(df.schema[id_col].dataType, T.NumericType)
    return F.col(id_col).cast("bigint") if numeric else F.xxhash64(id_col)


def within_sample(
    df: DataFrame, quota: Quota, id_col: str = "row_id", salt: str = "sample", wanted: Column | None = None
) -> Column:
    """A column that is true for the rows of ``df`` with the smallest id hash, up to the quota.

    ``quota`` gets the number of rows that are ``wanted``, all by default, and of the others.
    """
    h, number = hash_hex(id_col, salt), _id(df, id_col)
    mine = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    leading = F.conv(F.substring("h", 1, 15), 16, 10).cast("bigint")  # grows with the hash
    ids = written(df.select(h.alias("h"), number.alias("id"), mine.alias("wanted")).select(leading.alias("b"), "*"), "sample-ids")
    counts = ids.agg(F.count_if("wanted").alias("total"), F.count_if(~F.col("wanted")).alias("others"))
    sizes = counts.select("total", quota(F.col("total"), F.col("others")).cast("bigint").alias("quota")).first()
    if sizes.quota >= sizes.total:
        return F.lit(True)
    last = _nth(ids.where("wanted"), sizes.quota, ["b", "h", "id"])
    if last is None:
        return F.lit(False)
    return F.struct(h.alias("h"), number.alias("id")) <= F.struct(F.lit(last.h).alias("h"), F.lit(last.id).cast("bigint").alias("id"))


def cap_source(df: DataFrame, n: int, id_col: str = "row_id", salt: str = "cap") -> DataFrame:
    """Exactly ``n`` rows by hash order when there are more, else all."""
    return df.where(within_sample(df, lambda total, others: F.lit(n), id_col, salt))


def first_rows(df: DataFrame, n: int, id_col: str = "row_id") -> DataFrame:
    """A04, other mode: the first ``n`` rows by id. The id found reaches the scan of the rows as a plain filter."""
    ids = written(df.select(F.col(id_col).cast("bigint").alias("id")), "first-ids")
    last = _nth(ids, n, ["id"])
    return df.where(F.col(id_col) <= F.lit(last.id)) if last else df if n > 0 else df.limit(0)


def select_quota(ratio: float) -> Quota:
    """How many SELECT rows may stay next to all others."""
    if not 0 <= ratio < 1:
        raise ValueError("ratio must be at least 0 and below 1")
    factor = F.lit(ratio / (1.0 - ratio))
    return lambda total, others: F.when(others > 0, F.floor(others * factor)).otherwise(total)


def rebalance(
    df: DataFrame,
    ratio: float = 0.77,
    kind: str = "sql_type",
    sql: str = "sql",
    id_col: str = "row_id",
    salt: str = "rebalance",
) -> DataFrame:
    """All rows that are not SELECT, and as many SELECT rows as the ratio allows.

    Rows without SQL are dropped; :func:`quarrysql.operators.profile.ledger` counts them.
    """
    usable = df.where(F.col(sql) != "")
    is_select = F.col(kind) == "SELECT"
    return usable.where(~is_select | within_sample(usable, select_quota(ratio), id_col, salt, is_select))


def rebalance_report(before: DataFrame, after: DataFrame, kind: str = "sql_type") -> DataFrame:
    """Rows and share per kind before and after, and the reduction."""

    def counted(df: DataFrame, suffix: str) -> DataFrame:
        n = df.groupBy(kind).agg(F.count("*").alias(f"n_{suffix}"))
        # One row per kind, a fixed list.
        share = F.col(f"n_{suffix}") * 100.0 / F.sum(f"n_{suffix}").over(Window.partitionBy())
        return n.withColumn(f"pct_{suffix}", share)

    both = counted(before, "before").join(counted(after, "after"), kind, "full")
    for c in ("n_before", "n_after"):
        both = both.withColumn(c, F.coalesce(c, F.lit(0)))
    for c in ("pct_before", "pct_after"):
        both = both.withColumn(c, F.coalesce(c, F.lit(0.0)))
    return both.withColumn("removed", F.col("n_before") - F.col("n_after"))


def shuffle(df: DataFrame, id_col: str = "row_id", salt: str = "shuffle") -> DataFrame:
    """The same pseudo-random order on every run, by a range exchange on the id hash."""
    return df.orderBy(hash_hex(id_col, salt), id_col)


def train_val_split(
    df: DataFrame, share: float = 0.1, id_col: str = "row_id", salt: str = "split", exact: bool = False
) -> DataFrame:
    """Adds ``split``. Membership depends on the id only, unless ``exact`` asks for the exact share."""
    if exact:
        held_out = within_sample(df, lambda total, others: F.ceil(total * F.lit(share)), id_col, salt)
    else:
        parts = 10_000
        held_out = F.pmod(hash_bucket(id_col, salt), F.lit(parts)) < F.lit(round(share * parts))
    return df.withColumn("split", F.when(held_out, "validation").otherwise("train"))
