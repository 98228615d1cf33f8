"""Ranks and running totals over groups of any size.

A plain window puts a whole group into one task. Here one range exchange sorts the rows by group and value, and may cut a
group, or a tie within it, anywhere. Each task numbers and sums what it holds, as if nothing came before. Then one row a task,
with the first and last group and value it holds and their counts, says what it has to add for the tasks
before it, and to the last tie for those behind it. Ties share a value, so ranks and RANGE totals stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrysql.session import written

#: What a task adds to a row: its task, the number of its group and tie there, and its counts and sums as far as the task sees.
_LOCAL = ["_part", "_group", "_tie", "_row", "_rank", "_dense", "_sum", "_tie_sum"]


def _changed(before: pa.Array | None, values: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; null equals null, and NaN equals NaN. ``before`` is the last of the last batch."""
    lead = values if before is None else pa.concat_arrays([before, values])
    a, b = lead.slice(1), lead.slice(0, len(lead) - 1)
    differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(values.type):
        differ = pc.and_not(differ, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    found = differ.to_numpy(zero_copy_only=False)
    return np.concatenate([[True], found]) if before is None else found


class _Numbers:
    """Counts and sums along rows sorted by group and value."""

    def __init__(self) -> None:
        self.group = self.tie = -1
        self.rows = self.before_tie = self.dense = self.sum = 0

    def take(self, new_group: np.ndarray, new_tie: np.ndarray, amount: np.ndarray) -> list[np.ndarray]:
        """The columns of ``_LOCAL`` but the first; sums are those of ties that end within these rows."""
        goes_on = not new_tie[0]  # the first rows belong to the last tie
        start = np.flatnonzero(new_tie) if not goes_on else np.concatenate([[0], np.flatnonzero(new_tie)])
        size, opens = np.diff(start, append=len(new_tie)), new_group[start]
        of_group, first = np.cumsum(opens), np.flatnonzero(opens)
        tie_sum, index = np.add.reduceat(amount, start), np.arange(len(start))
        ahead, total = np.cumsum(size) - size, np.cumsum(tie_sum)
        before = ahead - np.concatenate([[-self.rows], ahead[first]])[of_group]
        rank = before.copy()
        rank[0] = self.before_tie if goes_on else rank[0]
        dense = index - np.concatenate([[-self.dense - (not goes_on)], first - 1])[of_group]
        sums = total - np.concatenate([[-self.sum], (total - tie_sum)[first]])[of_group]
        tie = np.repeat(index, size)
        out = [
            self.group + of_group[tie], self.tie + tie + (not goes_on), before[tie] + np.arange(len(tie)) - start[tie] + 1,
            rank[tie] + 1, dense[tie], sums[tie], tie_sum[tie],
        ]
        self.group, self.tie = int(out[0][-1]), int(out[1][-1])
        self.rows, self.before_tie, self.dense, self.sum = int(out[2][-1]), int(rank[-1]), int(dense[-1]), int(sums[-1])
        return out


def _cumulated(df: DataFrame, keys: list[str], order: str, descending: bool, tie_break: str | None, amount: Column | None) -> DataFrame:
    """``df`` with ``_row``, ``_rank``, ``_dense`` and ``_sum`` over its groups. ``amount`` is a column of whole numbers."""
    summed = amount is not None
    spark, parts = df.sparkSession, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.desc(order) if descending else F.asc(order)
    by = [*[F.asc(k) for k in keys], value, *([F.asc(tie_break)] if tie_break else []), F.asc("_at")]
    rows = df.withColumns({"_amount": F.lit(0).cast("bigint") if amount is None else F.coalesce(amount, F.lit(0)).cast("bigint"), "_at": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, numbers, last, waiting = TaskContext.get().partitionId(), _Numbers(), {}, []

        def numbered(held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            batch = pa.Table.from_batches([b for b, _, _ in held]).combine_chunks().to_batches()[0] if len(held) > 1 else held[0][0]
            found = numbers.take(*[np.concatenate([h[k] for h in held]) for k in (1, 2)], batch.column("_amount").to_numpy())
            columns = [pa.array(np.full(batch.num_rows, part, np.int64)), *[pa.array(c.astype(np.int64)) for c in found]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *_LOCAL])

        for batch in batches:
            if not batch.num_rows:
                continue
            change = {c: _changed(last.get(c), batch.column(c)) for c in (*keys, order)}
            new_group = np.logical_or.reduce([np.arange(batch.num_rows) < (not last), *[change[k] for k in keys]])
            last = {c: batch.column(c).slice(batch.num_rows - 1) for c in (*keys, order)}
            new_tie = new_group | change[order]
            if not summed:
                yield from numbered([(batch, new_group, new_tie)])
                continue
            # The sum of a tie is known at its end: the rows of the last one wait. A task holds them anyway, as its share of the sort.
            begin = np.flatnonzero(new_tie)
            if len(begin) and (waiting or begin[-1]):
                whole = (batch.slice(0, begin[-1]), new_group[: begin[-1]], new_tie[: begin[-1]])
                yield from numbered([*waiting, whole] if begin[-1] else waiting)
                waiting = []
            cut = begin[-1] if len(begin) else 0
            waiting.append((batch.slice(cut), new_group[cut:], new_tie[cut:]))
        if waiting:
            yield from numbered(waiting)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    kept = written(ranged.mapInArrow(run, f"{fields}, {', '.join(f'{c} bigint' for c in _LOCAL)}"), "windows")
    carry = spark.createDataFrame(_carried(kept, keys, order), "_part long, n long, d long, s long, tie long, last long, after long")
    joined = kept.join(F.broadcast(carry), "_part")  # one row a task
    add = lambda c: F.when(F.col("_group") == 0, F.col(c)).otherwise(0)
    shared = F.when(F.col("_tie") == 0, F.col("tie")).otherwise(0)
    behind = F.when(F.col("_tie") == F.col("last"), F.col("after")).otherwise(0)
    return joined.select(
        *df.columns, (F.col("_row") + add("n")).alias("_row"), (F.col("_rank") + add("n") - shared).alias("_rank"),
        (F.col("_dense") + add("d")).alias("_dense"), (F.col("_sum") + add("s") + behind).alias("_sum"),
    )


def _carried(kept: DataFrame, keys: list[str], order: str) -> list[tuple]:
    """For each task what its first group had before it, in rows, different values and sum, what its first tie had, and what its last tie has behind it."""
    named = F.struct(F.struct(*keys).alias("group"), F.col(order).alias("value")) if keys else F.struct(F.lit(0).alias("group"), F.col(order).alias("value"))
    at = F.struct("_tie", "_row")
    edges = sorted(
        kept.groupBy("_part").agg(
            F.min_by(named, at).alias("first"), F.max_by(named, at).alias("last"),
            F.max_by(F.struct("_group", "_tie", "_row", "_rank", "_dense", "_sum"), at).alias("end"), F.min_by("_tie_sum", at).alias("first_tie"),
        ).collect(),
        key=lambda e: e["_part"],
    )
    same = lambda a, b: a == b or repr(a) == repr(b)  # noqa: E731 (a NaN is equal to itself)
    out, n, d, s, tie = [], 0, 0, 0, 0
    for k, e in enumerate(edges):
        goes_on = k > 0 and same(edges[k - 1]["last"].group, e["first"].group)
        in_tie = goes_on and same(edges[k - 1]["last"].value, e["first"].value)
        mine = (n, d - in_tie, s, tie if in_tie else 0) if goes_on else (0, 0, 0, 0)
        out.append([e["_part"], *mine, e["end"]["_tie"], 0, in_tie])
        own = mine if e["end"]["_group"] == 0 else (0, 0, 0, 0)
        n, d, s = own[0] + e["end"]["_row"], own[1] + e["end"]["_dense"], own[2] + e["end"]["_sum"]
        tie = e["end"]["_row"] - e["end"]["_rank"] + 1 + (mine[3] if e["end"]["_tie"] == 0 else 0)
    for k in range(len(out) - 2, -1, -1):
        if out[k + 1][7]:
            out[k][6] = edges[k + 1]["first_tie"] + (out[k + 1][6] if out[k + 1][5] == 0 else 0)
    return [tuple(row[:7]) for row in out]


def ranked(df: DataFrame, keys: list[str], order: str, tie_break: str | None = None, descending: bool = False) -> DataFrame:
    """Adds ``rank`` and ``dense_rank`` of ``order`` within ``keys``, and ``row_number``, by ``tie_break`` where given, among ties."""
    placed = _cumulated(df, keys, order, descending, tie_break, None)
    names = {"rank": "_rank", "dense_rank": "_dense", "row_number": "_row"}
    return placed.select(*df.columns, *[F.col(c).alias(name) for name, c in names.items()])


def running_total(df: DataFrame, keys: list[str], order: str, amount: Column, name: str = "running_total") -> DataFrame:
    """Adds the sum of ``amount`` up to and including the row's ``order`` value; ties share a total, and null counts nothing.

    ``amount`` is a whole number or a decimal, whose units a group may add up to 2 ** 63 of; sums of floats depend on the order of rows.
    """
    kind = df.select(amount.alias("a")).schema["a"].dataType
    if isinstance(kind, T.DecimalType):
        unit = F.lit(Decimal(1).scaleb(-kind.scale))
        units, back = amount * F.lit(10**kind.scale), (lambda c: c.cast("decimal(20,0)") * unit)
    elif isinstance(kind, T.IntegralType):
        units, back = amount, (lambda c: c)
    else:
        raise TypeError(f"a running total needs whole numbers or decimals, not {kind.simpleString()}")
    return _cumulated(df, keys, order, False, None, units).select(*df.columns, back(F.col("_sum")).alias(name))
