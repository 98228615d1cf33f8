"""Fixed-length token ids from a vocabulary that Spark builds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.functions.text import unicode_pattern
from quarrysql.session import cut_lineage, written

PAD_ID = 0
#: A chunk of texts ends with so many characters; all its texts share one list of tokens.
CHUNK = 8_000_000
_SPACES = unicode_pattern(r"\s+")


def tokens(text) -> F.Column:
    """Words between white space, in order."""
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def build_vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """``token, n, token_id``: dense ids from 1, most frequent first, ties by token.

    Counting combines before the exchange. The sort is a range exchange, written out once; ids are the
    position in a partition plus the rows of the partitions before, one row per partition. The numbered
    table is written, as it is read more than once.
    """
    counted = df.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    ordered = cut_lineage(counted.orderBy(F.desc("n"), "token"))
    # The id of the written partition is in the upper bits, the position in it in the lower 33.
    placed = ordered.withColumn("_m", F.monotonically_increasing_id()).select(
        "token", "n", F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_i")
    )
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_size"))
    starts = sizes.select("_p", (F.sum("_size").over(Window.orderBy("_p")) - F.col("_size")).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_p")  # one row per shuffle partition
    return written(numbered.select("token", "n", (F.col("_start") + F.col("_i") + 1).alias("token_id")), "vocabulary")


def _chunked(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Texts in chunks, each followed by the different tokens of the chunk: (chunk, id, text) or (chunk, token)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, seen = TaskContext.get().partitionId() << 32, 0, set()
        id_type = pa.null()

        def listed() -> pa.RecordBatch:
            own = pa.array(list(seen), pa.string())
            numbers = pa.array(np.full(len(own), chunk, np.int64))
            return pa.RecordBatch.from_arrays([numbers, pa.nulls(len(own), id_type), pa.nulls(len(own), pa.string()), own], names=["chunk", "id", "text", "token"])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            id_type, at = ids.type, 0
            for k, t in enumerate(texts.to_pylist()):
                seen.update((t or "").split())
                size += len(t or "")
                if size >= CHUNK or k == len(texts) - 1:
                    n = k + 1 - at
                    numbers = pa.array(np.full(n, chunk, np.int64))
                    yield pa.RecordBatch.from_arrays([numbers, ids.slice(at, n), texts.slice(at, n), pa.nulls(n, pa.string())], names=["chunk", "id", "text", "token"])
                    at = k + 1
                if size >= CHUNK:
                    yield listed()
                    chunk, size = chunk + 1, 0
                    seen.clear()
        if seen:
            yield listed()

    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"chunk bigint, id {kind}, text string, token string")


def encode_fixed(df: DataFrame, vocabulary: DataFrame, id_col: str, text: str = "text", max_len: int = 1536) -> DataFrame:
    """Whole texts in windows of exactly ``max_len`` entries: ``window`` from 0, ``input_ids``, ``attention_mask`` and ``labels``.

    The last window of a text is padded; a text without tokens has one window of padding. Every token appears once; those
    that the vocabulary does not know are left out. The vocabulary is joined to the different tokens of chunks of texts, not to
    their occurrences, so a frequent token is one row a chunk, and the texts are exchanged once, by chunk.
    """
    kind = df.schema[id_col].dataType.simpleString()
    chunks = written(_chunked(df, id_col, text), "chunks")
    known = chunks.where("token IS NOT NULL").select(F.col("chunk").alias("own"), "token").join(vocabulary.select("token", "token_id"), "token")
    texts = chunks.where("token IS NULL").select("chunk", "id", "text")

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        place = dict(zip(known["token"].to_pylist(), known["token_id"].to_pylist(), strict=True))
        rows, windows, ids = [], [], []
        for k, t in enumerate(texts["text"].to_pylist()):
            own = np.fromiter((place.get(w, -1) for w in (t or "").split()), np.int64)
            own = own[own >= 0]
            for window, at in enumerate(range(0, max(1, len(own)), max_len)):
                rows.append(k)
                windows.append(window)
                ids.append(own[at : at + max_len])
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.empty(0, np.int64)])))
        return pa.table([texts["id"].take(pa.array(rows, pa.int64())), pa.array(windows, pa.int32()), flat], names=["id", "window", "ids"])

    cut = texts.groupBy("chunk").cogroup(known.groupBy("own")).applyInArrow(run, f"id {kind}, window int, ids array<bigint>")
    gap = F.lit(max_len) - F.size("ids")
    padded = F.concat("ids", F.array_repeat(F.lit(PAD_ID).cast("bigint"), gap))
    mask = F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), gap))
    full = cut.select(F.col("id").alias(id_col), "window", padded.alias("input_ids"), mask.alias("attention_mask"))
    return full.withColumn("labels", F.col("input_ids"))
