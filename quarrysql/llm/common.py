"""What the operators share: texts, words, labelled samples, global row numbers."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysql.session import written

#: A word, as every contract of this package counts them.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of text per Arrow batch. Texts can be long, and the default of 10,000 rows can exceed a worker.
TEXT_ROWS = 500
#: Bytes per Arrow batch; a batch holds one row at least.
TEXT_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Types of the columns of local tables.
_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table from rows that the driver holds. Spark knows its size, and broadcasts it when it is small enough."""
    fields = [f.split() for f in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in fields]))


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Sends texts to Python workers in batches of ``rows`` rows or ``TEXT_BYTES`` bytes, whichever are fewer."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES))


def freed() -> None:
    """Gives memory that a worker no longer uses back to the machine, at the end of a task that used much."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


#: What operators remember in this worker from task to task.
_held: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What ``owner`` remembers in this worker. Whatever others remember is let go: workers go from one operator to the next."""
    for other in [o for o in _held if o != owner]:
        del _held[other]
    return _held.setdefault(owner, {})


def text_of(column: str = "text") -> Column:
    """A text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def is_fold(column: str, parts: int, held: int) -> Column:
    """Whether an id falls in the held-out fold; false for a null id."""
    return F.coalesce(fold(column, parts) == held, F.lit(False))


def words(text: str | None) -> list[bytes]:
    """The words of a text as bytes; bytes.split() splits at exactly the six characters that WORD excludes."""
    return (text or "").encode().split()


def labelled_sample(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` training ids with their label, as a local table.

    Ids of the held-out fold (crc32 mod 5 = 0), null ids and null labels take no part. Several labels of one
    id are averaged, halves count as 1. The ids are the first by hash, so the sample is the same on each run.
    """
    rows = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("double").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & (fold("id", 5) != 0))
        .groupBy("id")
        .agg(F.avg("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(limit)
        .collect()
    )
    return local(labels.sparkSession, [(r.id, int(r.y >= 0.5)) for r in rows], "id long, y int")


#: Equal rows are numbered in runs of at most this many, so that no task makes an unbounded number of them.
RUN = 50_000


def numbered(df: DataFrame, order: list[str], label: str) -> tuple[DataFrame, int]:
    """Global row numbers 0, 1, ... in the order of ``order`` and then of all other columns.

    Returns (struct ``row`` with the columns of ``df``, long ``number``) and the number of rows. Equal rows are
    counted before the exchange and split into runs, so that a range exchange deals even a third of all rows
    out to many tasks. The rows are written once; only the row count of each partition reaches the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("row")[c] for c in [*order, *(c for c in df.columns if c not in order)]]
    runs = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("row", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))).alias("run"))
        .select("row", "run", F.least(F.lit(RUN).cast("long"), F.col("n") - F.col("run") * RUN).alias("m"))
        .repartitionByRange(parts, *keys, "run")
        .sortWithinPartitions(*keys, "run")
    )
    rows = runs.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("i")).select(
        "row", F.monotonically_increasing_id().alias("place")
    )
    kept = written(rows, label)
    part = F.shiftright("place", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    at, offsets = 0, []
    for r in sorted(sizes, key=lambda r: r.part):
        offsets.append((r.part, at))
        at += r.n
    starts = local(spark, offsets, "part long, start long")  # one row a partition
    joined = kept.withColumn("part", part).join(F.broadcast(starts), "part")
    return joined.select("row", (F.col("start") + F.col("place") - F.shiftleft("part", 33)).alias("number")), at
