"""Quality classifier: hashed word n-grams, logistic regression trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import freed, held, labelled_sample, small_batches, words

#: Training documents read at most: the documented bound of the sample.
SAMPLE = 6_000
#: Slots of words, and after them those of shapes, in bits.
BITS, SHAPE_BITS = 20, 16
SLOTS = (1 << BITS) + (1 << SHAPE_BITS) + 2
#: Step, smoothing and penalties of the updates, passes over the sample, and the share of 1 that accepts a text.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.05, 0.5, 4
ACCEPT = 0.3


# What the shape of a word keeps of its characters: letters by case, digits, the marks . and , and one sign for all others.
_SHAPE = bytes(
    97 if c >= 128 or 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c if c in b" \t\n\x0b\x0c\r.," else 42
    for c in range(256)
)


def shapes(text: str | None) -> list[bytes]:
    """The shape of each word, runs of one sign written once: ``Then,`` is ``Aa,`` and ``the&&&`` is ``a*``."""
    line = np.frombuffer((text or "").encode().translate(_SHAPE), np.uint8)
    kept = np.ones(len(line), bool)
    kept[1:] = line[1:] != line[:-1]
    return line[kept].tobytes().split()


def _block(listed: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the one- and two-word shingles of a list, and their counts scaled to length 1."""
    one = np.fromiter(map(crc32, listed), np.uint64, len(listed))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = np.concatenate([one * np.uint64(0xD6E8FEB86659FD93), two * np.uint64(0xFF51AFD7ED558CCD)])
    slots, counts = np.unique((mixed >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
    return slots, counts / max(1.0, np.sqrt(np.square(counts, dtype=np.float64).sum()))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: shingles of its words, which keep case and marks, and of their shapes.

    The last two slots are the share of words that repeat the word before them, as a root, and the intercept.
    An empty text has the intercept alone.
    """
    own = words(text)
    again = sum(map(eq, own, own[1:])) / max(1, len(own) - 1)
    (a, x), (b, y) = _block(own, BITS), _block(shapes(text), SHAPE_BITS)
    return np.concatenate([a, b + (1 << BITS), [SLOTS - 2, SLOTS - 1]]), np.concatenate([x, y, [again**0.5, 1.0]])


@dataclass
class Leader:
    """State of the updates: per slot the sum of adjusted gradients, and of squared gradients."""

    z: np.ndarray
    n: np.ndarray

    def weights(self, slots: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        g = (sigmoid(w @ values) - label) * values
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = n + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights, SLOTS floats, from at most ``sample`` labelled documents.

    Executors turn texts into slots; only those of the sample reach the driver. No label at all, as in empty tables, gives zeros,
    so that every text scores 0.5. Null ids and null labels teach nothing; null and empty texts teach the intercept; labels of one id
    are averaged, and rows that repeat an id are texts of their own. Other columns of either table are ignored.
    """
    small_batches(docs.sparkSession)
    chosen = labelled_sample(labels, label, sample)

    @F.pandas_udf("struct<slots: binary, values: binary>")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        found = [features(t) for t in texts]
        return pd.DataFrame({"slots": [s.astype(np.int32).tobytes() for s, _ in found], "values": [v.astype(np.float32).tobytes() for _, v in found]})

    rows = (
        docs.select(F.col("doc_id").alias("id"), "text")
        .join(chosen, "id")
        .select("id", "y", hashed("text").alias("f"))
        .collect()
    )
    rows.sort(key=lambda r: (crc32(str(r.id).encode()), r.id, bytes(r.f.slots), bytes(r.f["values"])))
    leader = Leader(np.zeros(SLOTS), np.zeros(SLOTS))
    for _ in range(PASSES):
        for r in rows:
            leader.learn(np.frombuffer(r.f.slots, np.int32), np.frombuffer(r.f["values"], np.float32).astype(np.float64), r.y)
    return leader.weights(slice(None)).astype(np.float32)


def scorer(spark, weights: np.ndarray, text: str = "text") -> Column:
    """Probability of label 1 for each whole text. The weights have a fixed size and go to each worker once.

    Null and empty texts have the intercept's score. Equal texts have equal scores.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held("quality")
        w = shared.value
        for texts in batches:
            yield pd.Series([float(sigmoid(w[s] @ v)) for s, v in map(features, texts)], dtype="float64")
        freed()

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")(F.col(text))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns.

    Null and empty texts have the intercept's score. Repeated rows have equal scores and stay or go together.
    A null id only keeps a row out of training.
    """
    return docs.where(scorer(docs.sparkSession, train(docs, labels)) >= ACCEPT)
