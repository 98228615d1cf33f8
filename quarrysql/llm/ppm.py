"""Scoring texts by prediction by partial matching over bytes.

The trie holds the contexts of up to three bytes that the training texts hold, with counts of what followed. A byte
is predicted in its longest context; if it never followed there, the coder escapes to the context one byte shorter. The
escape has the weight of the number of different bytes seen (method C), and bytes that were seen in a longer context are
excluded from the shorter ones. Below the empty context all 256 symbols are equally likely. Byte 0xFF, which UTF-8 never
uses, stands before and after each text.

The trie is counted from all training texts. What may follow two symbols is a table of at most 256 ** 3 counts, which
each worker has. The contexts of three symbols, as many as the training texts hold, stay a table of Spark: each has the
counts of what followed, and what these exclude from its last two symbols. Texts are cut into chunks; a chunk asks that table
once for each of its different runs of four symbols.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.llm.common import is_fold, small_batches
from quarrysql.session import written

EDGE = 0xFF
#: A chunk of texts, which share one list of words and one of runs, ends with so many tokens or bytes, or half as many different runs.
CHUNK, BYTES, RUNS = 3_000_000, 16_000_000, 2_000_000
#: Bytes of texts whose runs are looked up at a time.
SLICE = 2_000_000


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with three edges before each and one after the last, and the places of the symbols to predict.

    Those are the bytes of each text and the edge after it.
    """
    edge = bytes([EDGE])
    line = np.frombuffer(edge * 3 + (edge * 3).join(texts) + edge, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = 3 + np.concatenate([[0], np.cumsum(sizes[:-1] + 3)]) if len(texts) else np.empty(0, np.int64)
    wanted = np.ones(len(line), bool)
    wanted[:3] = False
    for k in (1, 2):
        wanted[(starts + sizes + k)[:-1]] = False
    return line, np.flatnonzero(wanted)


def runs(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs of four symbols that end at the places ``at``, as 32-bit numbers."""
    x = line.astype(np.uint32)
    return (x[at - 3] << 24) | (x[at - 2] << 16) | (x[at - 1] << 8) | x[at]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)


@dataclass
class Lower:
    """code: symbol to its number, the last for all that training never saw. count: how often a symbol followed two others.

    total, different: for two symbols, how many symbols followed and how many different ones. below: P of a symbol that never
    followed the two, once the coder has escaped from them.
    """

    code: np.ndarray
    count: np.ndarray
    total: np.ndarray
    different: np.ndarray
    below: np.ndarray

    def logs(self, run: np.ndarray, n: np.ndarray, total: np.ndarray, different: np.ndarray, excluded: np.ndarray) -> np.ndarray:
        """log10 P of the last symbol of each run after the first three.

        n: how often the run was seen; total, different: how many symbols, and different ones, followed its first three;
        excluded: how often these followed the middle two. 0 where there is nothing.
        """
        symbol = [self.code[(run >> k) & 255] for k in (0, 8, 16)]
        pair = symbol[2] * len(self.total) + symbol[1]
        at = pair * len(self.total) + symbol[0]
        left = self.different.ravel()[pair] - different
        weight = np.maximum(self.total.ravel()[pair] - excluded + left, 1)
        count = self.count.ravel()[at]
        lower = np.where(count > 0, count / weight, np.where(left > 0, left / weight, 1.0) * self.below.ravel()[at])
        own = np.maximum(total + different, 1)
        return np.log10(np.where(n > 0, n / own, np.where(different > 0, different / own, 1.0) * lower))


def _step(counts: np.ndarray, excluded: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Distributions of one order, along the last axis: own counts without the excluded symbols, the rest from ``below``.

    ``below`` must already leave out every symbol with a count here.
    """
    own = np.where(excluded, 0.0, counts)
    different = (own > 0).sum(axis=-1, keepdims=True)
    total = own.sum(axis=-1, keepdims=True) + different
    safe = np.where(total > 0, total, 1)
    return np.where(counts > 0, own / safe, np.where(different > 0, different / safe, 1.0) * below)


def lower(found: pd.DataFrame) -> Lower:
    """Tables from counts of runs of three symbols (run, n)."""
    used = np.unique(np.concatenate([(found.run.to_numpy() >> k) & 255 for k in (0, 8, 16)] + [[EDGE]]))
    s = len(used) + 1
    code = np.full(256, s - 1, np.int64)
    code[used] = np.arange(len(used))
    at = lambda runs, k: code[(runs >> (8 * k)) & 255]
    three = np.zeros((s, s, s))
    r = found.run.to_numpy()
    three[at(r, 2), at(r, 1), at(r, 0)] = found.n
    one, none = three.sum(axis=0), three.sum(axis=(0, 1))

    seen = int((none > 0).sum())
    flat = np.full(s, 1.0 / max(1, 256 - seen))  # every symbol that the empty context has not seen
    low = _step(none[None, :], one > 0, flat[None, :])
    below = np.empty((s, s, s), np.float32)
    for a in range(s):  # one first symbol at a time, to bound memory
        below[a] = _step(one, three[a] > 0, low)
    return Lower(code, three.astype(np.float32), three.sum(axis=2), (three > 0).sum(axis=2).astype(np.float64), below)


def trie(found: DataFrame) -> DataFrame:
    """All contexts of three symbols of the runs of four in ``found`` (run, n).

    (context, total, different, excluded, after): how many symbols followed, how many different ones, how often those
    followed the last two symbols, and how often each followed. A context has at most 256 rows, and so has an end of three.
    """
    end = Window.partitionBy(F.col("run") % (1 << 24))
    return (
        found.withColumn("short", F.sum("n").over(end))
        .groupBy(F.shiftright("run", 8).alias("context"))
        .agg(
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("different"),
            F.sum("short").alias("excluded"),
            F.map_from_entries(F.collect_list(F.struct(F.col("run") % 256, "n"))).alias("after"),
        )
    )


def _encoded(docs: DataFrame) -> DataFrame:
    """The texts in chunks, and the words and runs of each chunk.

    Rows with ``word`` or ``run`` are those of a chunk, with n, the count in its training texts. The others are documents:
    doc_id, held_out, and ``text`` as bytes.
    """
    names = ["chunk", "word", "run", "n", "doc_id", "held_out", "text"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def batch_of(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[n], k) if n in columns else pa.nulls(size, k) for n, k in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, tokens, size = TaskContext.get().partitionId(), 0, 0, 0
        place: defaultdict = defaultdict()
        place.default_factory = place.__len__
        learnt: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def lists() -> Iterator[pa.RecordBatch]:
            chunk = (part << 32) + number
            n = np.bincount(np.concatenate([*learnt, np.empty(0, np.int32)]).astype(np.int64), minlength=len(place))
            listed = list(place)
            for k in range(0, len(listed), 100_000):
                own = listed[k : k + 100_000]
                yield batch_of(len(own), chunk=[chunk] * len(own), word=own, n=n[k : k + len(own)])
            key, n = _merged(keys, counts) if keys else (np.empty(0, np.int64), np.empty(0, np.int64))
            for k in range(0, len(key), 100_000):
                own = key[k : k + 100_000].astype(np.int64)
                yield batch_of(len(own), chunk=np.full(len(own), chunk), run=own, n=n[k : k + len(own)])

        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            held = batch.column(2).to_pylist()
            for text, out in zip(texts, held):
                own = text.lower().split()
                code = np.fromiter(map(place.__getitem__, own), np.int32, len(own))
                tokens += len(own)
                size += len(text)
                if not out:
                    learnt.append(code)
            for out in (False, True):
                own = [t for t, h in zip(texts, held) if h == out]
                if own:
                    key, n = np.unique(runs(*laid_out(own)), return_counts=True)
                    keys.append(key)
                    counts.append(n * (not out))
            yield batch_of(len(texts), chunk=[(part << 32) + number] * len(texts), doc_id=batch.column(0), held_out=held, text=texts)
            full = tokens >= CHUNK or size >= BYTES
            if sum(map(len, keys)) > RUNS:
                key, n = _merged(keys, counts)
                keys, counts, full = [key], [n], full or len(key) > RUNS // 2
            if full:
                yield from lists()
                number += 1
                place.clear()
                learnt, keys, counts, tokens, size = [], [], [], 0, 0
        yield from lists()

    small_batches(docs.sparkSession)
    schema = "chunk long, word binary, run long, n long, doc_id long, held_out boolean, text binary"
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, schema)


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, about SLICE bytes at a time."""
    own, size = [], 0
    for text in texts:
        own.append(text)
        size += len(text) + 4
        if size >= SLICE:
            yield own
            own, size = [], 0
    if own:
        yield own


def report(docs: DataFrame, parts: int = 7, held: int = 2) -> DataFrame:
    """Base and model scores of each row of ``docs``.

    The model and the counts of the base learn from all rows whose crc32(doc_id as text) mod ``parts`` is not ``held``; a null id
    is never held out. A null text is an empty one: it has one token, its end. Repeated rows and ids count each
    time. Other columns are ignored. An empty table gives an empty result; without training rows N and V are 0.

    Word counts and contexts are joined to words and runs of chunks of texts, not to documents: a chunk asks once for each.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", is_fold("doc_id", parts, held).alias("held_out"))
    encoded = written(_encoded(rows), "ppm-encoded", "zstd")  # texts, words and runs: the larger part of what is on disk
    words, texts = encoded.where("word IS NOT NULL").select("chunk", "word", "n"), encoded.where("word IS NULL AND run IS NULL")
    four = encoded.where("run IS NOT NULL").select("chunk", "run", "n")
    found = written(four.where("n > 0").groupBy("run").agg(F.sum("n").alias("n")), "ppm-runs")
    short = found.groupBy((F.col("run") % (1 << 24)).alias("run")).agg(F.sum("n").alias("n")).toPandas()  # at most 256 ** 3
    shared = spark.sparkContext.broadcast(lower(short.astype("int64")))
    counts = written(words.groupBy("word").agg(F.sum("n").alias("n")), "ppm-words")
    ends = texts.where("NOT held_out").count()
    sums = counts.where("n > 0").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
    total, different = (sums.n or 0) + ends, sums.v + (ends > 0)
    none, nothing = F.lit(0).cast("long"), F.lit(None)
    asked_words = words.select(F.col("chunk").alias("own"), "word").join(counts, "word").select(
        "own", "word", none.alias("run"), "n", none.alias("total"), none.alias("different"), none.alias("excluded")
    )
    met = four.select(F.col("chunk").alias("own"), "run").join(trie(found), F.shiftright("run", 8) == F.col("context"), "left")
    asked_runs = met.withColumn("n", F.coalesce(F.try_element_at("after", F.col("run") % 256), none)).select(
        "own", nothing.cast("binary").alias("word"), "run", "n", F.coalesce("total", none).alias("total"), F.coalesce("different", none).alias("different"),
        F.when(F.col("n") > 0, none).otherwise(F.coalesce("excluded", none)).alias("excluded"),  # a run that was seen needs no more
    )

    def run(asked: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        is_run = asked.word.isna().to_numpy()
        four, words = asked[is_run].sort_values("run"), asked[~is_run]
        place = {bytes(w): k for k, w in enumerate(words.word)}
        n = words.n.to_numpy().astype(np.float64)
        weight, known = np.log10(n + 1), n > 0
        norm, end = np.log10(total + different + 1), np.log10(ends + 1)
        keys = four.run.to_numpy()
        logs = shared.value.logs(keys, *[four[c].to_numpy() for c in ("n", "total", "different", "excluded")])
        keys = keys.astype(np.uint32)
        out, scores = [], [np.empty(0)]
        for part in _slices([bytes(t) for t in texts.text]):
            for text in part:
                split = text.lower().split()
                own = np.fromiter(map(place.__getitem__, split), np.int64, len(split))
                out.append((len(own) + 1, int(known[own].sum()) + (ends > 0), weight[own].sum() + end - (len(own) + 1) * norm))
            sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
            scores.append(np.add.reduceat(logs[np.searchsorted(keys, runs(*laid_out(part)))], np.cumsum(sizes) - sizes))
        found = pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score"], index=texts.index)
        return texts[["doc_id", "held_out"]].join(found).assign(score=np.concatenate(scores))

    scored = asked_words.unionByName(asked_runs).groupBy("own").cogroup(texts.select("chunk", "doc_id", "held_out", "text").groupBy("chunk")).applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
