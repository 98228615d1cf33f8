"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A text is read as words of letters. Each word's input joins a learnt vector of the word, found by its hash, and the
mean of learnt vectors of its pairs of characters. Overlapping windows of WIDTH words, STRIDE apart, cover the whole text; in
each, a forward and a backward network read the words, attention weighs their states, and a linear layer gives the
window's logit. A text's logit is the largest of its windows, scaled to a probability on the training texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import labelled_sample, small_batches

#: Training texts read at most, each whole: the documented bound of the sample.
SAMPLE = 4_000
WIDTH, STRIDE = 32, 24
WORD_BITS, PAIR_BITS, INPUT, HIDDEN = 15, 12, 8, 8
#: Rounds, least updates in a round, windows in an update, step.
ROUNDS, UPDATES, BATCH, RATE = 4, 50, 256, 0.02
#: Windows that the network reads at a time when it scores.
SLICE = 2_048

_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-case runs of letters; all characters beyond ASCII count as letters."""
    return (text or "").lower().encode().translate(_LETTERS).split()


def starts(n: int) -> list[int]:
    """Where the windows of a text of ``n`` words begin; a text without words has one, empty."""
    return [0, *range(STRIDE, max(0, n - WIDTH + STRIDE), STRIDE)]


def hashed(listed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word the slot of its vector; the slots of all words' pairs of characters; and where each word's pairs begin."""
    slots = np.fromiter((crc32(w) & ((1 << WORD_BITS) - 1) for w in listed), np.int64, len(listed))
    line = np.frombuffer(b" " + b" ".join(listed) + b" ", np.uint8).astype(np.uint64)
    pairs = ((line[:-1] * np.uint64(256) + line[1:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)
    sizes = np.fromiter(map(len, listed), np.int64, len(listed)) + 1
    return slots, pairs.astype(np.int64), np.cumsum(sizes) - sizes


def _sum_rows(place: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(place, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Network:
    """Weights. ``gates`` and ``carry`` have one slice for each direction; their columns are update, reset, state."""

    word: np.ndarray
    pair: np.ndarray
    gates: np.ndarray
    bias: np.ndarray
    carry: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    scale: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape, by=1.0: (r.standard_normal(shape) * by).astype(np.float32)
        h = HIDDEN
        return cls(
            np.zeros((1 << WORD_BITS, INPUT), np.float32), draw(1 << PAIR_BITS, INPUT, by=0.1), draw(2, 2 * INPUT, 3 * h, by=0.35),
            np.zeros((2, 3 * h), np.float32), draw(2, h, 3 * h, by=0.35), draw(2 * h, by=0.1), np.append(draw(2 * h, by=0.3), np.float32(0)).astype(np.float32),
        )

    def inputs(self, listed: list[bytes]) -> tuple[np.ndarray, tuple]:
        """The input of each word, and the hashes it came from."""
        found = slots, pairs, begin = hashed(listed)
        if not listed:
            return np.zeros((0, 2 * INPUT), np.float32), found
        sizes = np.diff(np.append(begin, len(pairs)))
        chars = np.add.reduceat(self.pair[pairs], begin, axis=0) / sizes[:, None]
        return np.concatenate([self.word[slots], chars], axis=1), found

    def read(self, ahead: np.ndarray, tokens: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``ahead``: each word's part of the gates, by direction, a row of zeros last, for the padding."""
        n, h = len(tokens), HIDDEN
        states = np.zeros((2, WIDTH, n, h), np.float32)
        path = []
        for d in (0, 1):
            state = np.zeros((n, h), np.float32)
            for t in range(WIDTH) if d == 0 else range(WIDTH - 1, -1, -1):
                x = ahead[d][tokens[:, t]]
                u = state @ self.carry[d]
                gate = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
                z, r = gate[:, :h], gate[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
                if keep:
                    path.append((d, t, state, u[:, 2 * h :], z, r, new))
                state = (new + z * (state - new)) * mask[:, t, None]
                states[d, t] = state
        both = np.concatenate([states[0], states[1]], axis=2)  # place, window, state
        weight = np.where(mask.T, both @ self.attend, np.float32(-30))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        logits = pooled @ self.out[:-1] + self.out[-1]
        return (logits, both, weight, pooled, path) if keep else logits

    def ahead(self, inputs: np.ndarray) -> np.ndarray:
        gates = np.stack([inputs @ self.gates[d] + self.bias[d] for d in (0, 1)])
        return np.concatenate([gates, np.zeros((2, 1, gates.shape[2]), np.float32)], axis=1).astype(np.float32)

    def logits(self, windows: list[list[bytes]]) -> np.ndarray:
        """Logits of windows given as lists of words."""
        place: defaultdict = defaultdict()
        place.default_factory = place.__len__
        tokens = np.full((len(windows), WIDTH), -1, np.int64)
        for row, own in zip(tokens, windows):
            row[: len(own)] = list(map(place.__getitem__, own))
        return self._sliced(list(place), tokens)

    def _sliced(self, listed: list[bytes], tokens: np.ndarray) -> np.ndarray:
        ahead, mask = self.ahead(self.inputs(listed)[0]), tokens >= 0
        parts = [self.read(ahead, tokens[k : k + SLICE], mask[k : k + SLICE]) for k in range(0, len(tokens), SLICE)]
        return np.concatenate(parts) if parts else np.empty(0, np.float32)

    def text_scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each whole text, from all of its windows."""
        place: defaultdict = defaultdict()
        place.default_factory = place.__len__
        rows, sizes = [], []
        for text in texts:
            own = words(text)
            code = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
            begin = np.array(starts(len(own)))
            at = begin[:, None] + np.arange(WIDTH)
            rows.append(np.where(at < len(own), np.append(code, -1)[np.minimum(at, len(own))], -1))
            sizes.append(len(begin))
        found = self._sliced(list(place), np.concatenate(rows))
        best = np.maximum.reduceat(found, np.cumsum(sizes) - sizes)
        return _sigmoid(self.scale[0] * best.astype(np.float64) + self.scale[1])


class Trainer:
    """Adam for the network's layers, AdaGrad for the tables, of which a batch touches few rows."""

    def __init__(self, net: Network) -> None:
        self.net, self.steps = net, 0
        self.moments = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in ("gates", "bias", "carry", "attend", "out")}
        self.squares = {k: np.full_like(getattr(net, k), 1e-4) for k in ("word", "pair")}

    def learn(self, windows: list[list[bytes]], labels: np.ndarray) -> None:
        net, h = self.net, HIDDEN
        place: defaultdict = defaultdict()
        place.default_factory = place.__len__
        tokens = np.full((len(windows), WIDTH), -1, np.int64)
        for row, own in zip(tokens, windows):
            row[: len(own)] = list(map(place.__getitem__, own))
        inputs, (slots, pairs, begin) = net.inputs(list(place))
        mask = tokens >= 0
        logits, both, weight, pooled, path = net.read(net.ahead(inputs), tokens, mask, keep=True)
        d_logit = ((_sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        grads = {k: np.zeros_like(getattr(net, k)) for k in self.moments}
        grads["out"] = np.append(pooled.T @ d_logit, d_logit.sum())
        d_pooled = d_logit[:, None] * net.out[:-1]
        d_weight = (both * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grads["attend"] = np.einsum("tn,tnh->h", d_score, both)
        d_both = weight[:, :, None] * d_pooled + d_score[:, :, None] * net.attend
        d_ahead = np.zeros((2, len(place) + 1, 3 * h), np.float32)
        d_tokens = np.zeros((2, WIDTH, len(tokens), 3 * h), np.float32)
        flow = [np.zeros((len(tokens), h), np.float32)] * 2
        for d, t, state, u, z, r, new in reversed(path):
            back = (flow[d] + d_both[t][:, d * h : (d + 1) * h]) * mask[:, t, None]
            d_new = back * (1 - z) * (1 - new * new)
            d_z = back * (state - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            d_tokens[d, t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            grads["carry"][d] += state.T @ d_u
            flow[d] = back * z + d_u @ net.carry[d].T
        flat = np.where(mask, tokens, len(place)).T.ravel()
        for d in (0, 1):
            d_ahead[d] = _sum_rows(flat, d_tokens[d].reshape(-1, 3 * h), len(place) + 1)
        d_inputs = sum(d_ahead[d][:-1] @ net.gates[d].T for d in (0, 1))
        for d in (0, 1):
            grads["gates"][d] = inputs.T @ d_ahead[d][:-1]
            grads["bias"][d] = d_ahead[d][:-1].sum(axis=0)
        self._adam(grads)
        if len(place):
            sizes = np.diff(np.append(begin, len(pairs)))
            self._adagrad("word", slots, d_inputs[:, :INPUT])
            self._adagrad("pair", pairs, np.repeat(d_inputs[:, INPUT:] / sizes[:, None], sizes, axis=0))

    def _adam(self, grads: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, g in grads.items():
            one, two = self.moments[name]
            one += 0.1 * (g - one)
            two += 0.001 * (g * g - two)
            step = one / (1 - 0.9**self.steps) / (np.sqrt(two / (1 - 0.999**self.steps)) + 1e-8)
            getattr(self.net, name)[...] -= RATE / 2 * step

    def _adagrad(self, name: str, rows: np.ndarray, grads: np.ndarray) -> None:
        touched, place = np.unique(rows, return_inverse=True)
        g = _sum_rows(place, grads, len(touched)).astype(np.float32)
        self.squares[name][touched] += g * g
        getattr(self.net, name)[touched] -= RATE * 5 * g / np.sqrt(self.squares[name][touched])


def fitted(texts: list[tuple[list[list[bytes]], int]], seed: int = 5) -> Network:
    """A network from labelled texts, each a list of windows.

    The first round takes windows of all texts with their text's label. Later rounds take, of texts labelled 1, the windows
    that the network finds most toxic, and of the others the most toxic and a random one.
    """
    net, r = Network.fresh(), np.random.default_rng(seed)
    trainer = Trainer(net)
    positive = [i for i, (_, y) in enumerate(texts) if y]
    negative = [i for i, (_, y) in enumerate(texts) if not y]
    if not positive or not negative:
        net.scale = np.array([0.0, 4.0 if positive else -4.0 if negative else 0.0])
        return net

    def best() -> list[np.ndarray]:
        found = net.logits([w for own, _ in texts for w in own])
        ends = np.cumsum([len(own) for own, _ in texts])
        return np.split(found, ends[:-1])

    for round_ in range(ROUNDS):
        chosen: list[tuple[list[bytes], int]] = []
        found = best() if round_ else None
        for i in positive:
            own = texts[i][0]
            pick = range(len(own)) if found is None else np.argsort(-found[i], kind="stable")[:3]
            chosen += [(own[k], 1) for k in pick]
        each = max(1, len(chosen) // len(negative)) if found is None else 1
        for i in negative:
            own = texts[i][0]
            pick = [*r.integers(0, len(own), each)] + ([] if found is None else [int(found[i].argmax())])
            chosen += [(own[k], 0) for k in pick]
        until = trainer.steps + UPDATES
        while True:  # once over all, and again while the round has too few updates
            order = r.permutation(len(chosen))
            for k in range(0, len(order), BATCH):
                part = [chosen[j] for j in order[k : k + BATCH]]
                trainer.learn([w for w, _ in part], np.array([y for _, y in part], np.float32))
            if trainer.steps >= until:
                break
    x, y = np.array([b.max() for b in best()], np.float64), np.array([y for _, y in texts], np.float64)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps on the two numbers that scale the logit, held near 1 and 0 by a weak prior
        p = _sigmoid(a * x + b)
        w = p * (1 - p)
        g = np.array([((p - y) * x).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(hess, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -2, 2)
    net.scale = np.array([a, b])
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Network:
    """A network from at most ``sample`` labelled texts, of each all windows.

    Executors cut the windows; only those reach the driver. Without labels of both kinds, as from empty tables, all texts have one score.
    Null ids and null labels teach nothing; a null or empty text teaches its one empty window; labels of one id are averaged, and rows
    that repeat an id are texts of their own. Long texts give all their windows. Other columns of either table are ignored.
    """
    small_batches(docs.sparkSession)
    chosen = labelled_sample(labels, label, sample)

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            own = words(text)
            out.append([b" ".join(own[b : b + WIDTH]) for b in starts(len(own))])
        return pd.Series(out)

    rows = docs.select(F.col("doc_id").alias("id"), "text").join(chosen, "id").select("id", "y", cut("text").alias("w")).collect()
    rows.sort(key=lambda r: (crc32(str(r.id).encode()), r.id, [bytes(w) for w in r.w]))
    return fitted([([bytes(w).split() for w in r.w], r.y) for r in rows])


def scorer(spark, net: Network, text: str = "text") -> Column:
    """Probability of label 1 for each whole text. The network has a fixed size and goes to each worker once.

    Null and empty texts, and texts without letters, have the score of one empty window. Equal texts have equal scores.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(net)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = shared.value
        for texts in batches:
            yield pd.Series(net.text_scores(list(texts)) if len(texts) else [], dtype="float64")

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")(F.col(text))
