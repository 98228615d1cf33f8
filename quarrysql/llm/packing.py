"""Best-fit packing of token sequences, with matching of large items.

Lengths are whole numbers up to the room of a sequence, so the whole problem is a histogram of at most ``room``
counts, however many documents there are. The plan is made on that histogram: items above a third of the room are
matched greedily, the largest first, each with the largest partner that fits, at most two in a sequence; smaller
items go, the largest first, where the least gap is left. A plan is a list of patterns, each with the number of
sequences that follow it. Rows find their pattern by the global rank of their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import freed, held, numbered, small_batches
from quarrysql.session import written

ROOM = 2_048
TOKENIZER = "word_bpe_49k.json"
#: Id after each document.
END = 0

#: Texts with one of these characters, or with the start of a special token, go through the tokenizer whole.
OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa0-\u012f\u0131-\u017e]|<\|")
#: Texts that are looked up together: the more there are, the fewer times a word is, and the more room it takes.
ROWS = 500
#: Words whose ids a worker remembers, some 60 bytes each; beyond it, it starts anew.
KNOWN = 1_400_000
#: A text with a longer word goes through the tokenizer whole. Texts are looked at so many bytes at a time.
LONGEST, STRETCH = 255, 1 << 19
#: Stands between words that are learnt together: its id tells where the ids of the next word begin. So many words make a text, and
#: so many go to the tokenizer at a time.
BREAK, LEARNT, TOGETHER = "<|endoftext|>", 200, 10_000
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Encoder:
    """Ids of texts. No token spans white space, and most words come back: the ids of words are remembered.

    Words are known by two hashes of 64 bits, computed for all words of a stretch of text at once; a table sorted by the first
    holds the second and where the ids are. No word becomes an object of Python unless it is new.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each thread keeps memory of its own, and tasks take all cores as it is
        self.tokenizer = Tokenizer.from_file(path)
        self.end = self.tokenizer.token_to_id(BREAK)
        with np.errstate(over="ignore"):
            self.powers = [np.cumprod(np.full(STRETCH + LONGEST + 3, b, np.uint64)) for b in _BASES]
        self.forget()

    def forget(self) -> None:
        self.keys, self.checks = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.at, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _hashes(self, line: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Begin and end of each word of a line that begins and ends with a blank, and their hashes."""
        buffer = np.frombuffer(line, np.uint8)
        blank = (buffer == 32) | ((buffer >= 9) & (buffer <= 13))
        border = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        begin, end = border[::2], border[1::2]
        value = buffer.astype(np.uint64) + np.uint64(1)
        found = []
        for powers in self.powers:
            sums = np.cumsum(value * powers[: len(value)])
            found.append((sums[end - 1] - sums[begin - 1]) * powers[len(powers) - 1 - begin])
        return begin, end, found

    def _learn(self, words: list[str], keys: np.ndarray, checks: np.ndarray) -> None:
        """Remembers new words; ``keys`` are sorted, and none of them is known."""
        found = []
        for at in range(0, len(words), TOGETHER):  # what the tokenizer returns takes far more room than the ids in it
            own = [BREAK.join(words[k : min(k + LEARNT, at + TOGETHER)]) + BREAK for k in range(at, min(at + TOGETHER, len(words)), LEARNT)]
            found += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(own, add_special_tokens=False)]
        ids = np.concatenate(found)
        breaks = np.flatnonzero(ids == self.end)
        if len(breaks) != len(words):
            raise ValueError("the tokenizer does not keep its special token apart")
        sizes = np.diff(breaks, prepend=-1) - 1
        ids = ids[ids != self.end]
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        place = np.searchsorted(self.keys, keys)
        for name, new in (("keys", keys), ("checks", checks), ("at", self.used + np.cumsum(sizes) - sizes), ("sizes", sizes)):
            setattr(self, name, np.insert(getattr(self, name), place, new))
        self.used += len(ids)

    def _stretches(self, text: bytes) -> list[bytes] | None:
        """A text in stretches that end before white space; None if there is a word too long for that."""
        out, at = [], 0
        while len(text) - at > STRETCH:
            cut = max(text.rfind(mark, at, at + STRETCH) for mark in (b" ", b"\n"))
            if cut <= at:
                return None
            out.append(text[at:cut])
            at = cut
        return [*out, text[at:]]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each whole text; a null text has none."""
        lines: list[tuple[int, bytes]] = []
        whole = set()
        for k, text in enumerate(texts):
            if text:
                parts = None if OTHER.search(text) else self._stretches(text.lower().replace("\xa0", " ").encode())
                if parts is None:
                    whole.add(k)
                else:
                    lines += [(k, p) for p in parts]
        owner, hashes, words = [np.empty(0, np.int64)], [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)]], []
        group: list[tuple[int, bytes]] = []

        def looked_at() -> None:
            line = b" " + b" ".join(p for _, p in group) + b" "
            begin, end, found = self._hashes(line)
            sizes = np.fromiter((len(p) + 1 for _, p in group), np.int64, len(group))
            part = np.searchsorted(np.cumsum(sizes), begin - 1, side="right")
            of = np.fromiter((k for k, _ in group), np.int64, len(group))[part]
            short = end - begin <= LONGEST
            whole.update(of[~short].tolist())
            owner.append(of[short])
            for own, h in zip(hashes, found):
                own.append(h[short])
            words.append((line, begin[short], end[short]))
            group.clear()

        size = 0
        for k, part in lines:
            if group and size + len(part) + 1 > STRETCH:
                looked_at()
                size = 0
            group.append((k, part))
            size += len(part) + 1
        if group:
            looked_at()
        of, keys, checks = np.concatenate(owner), *(np.concatenate(h) for h in hashes)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = self._known(unique, checks[first])
        new = np.flatnonzero(place < 0)
        if len(new):
            if len(self.keys) + len(new) > KNOWN and len(self.keys):
                self.forget()
                yield from self.encode(texts)
                return
            starts = np.cumsum([0, *(len(b) for _, b, _ in words)])
            stretch = np.searchsorted(starts, first[new], side="right") - 1
            listed = []
            for s, w in zip(stretch.tolist(), (first[new] - starts[stretch]).tolist()):
                line, begin, end = words[s]
                listed.append(line[begin[w] : end[w]].decode())
            self._learn(listed, unique[new], checks[first[new]])
            place = self._known(unique, checks[first])
        same = checks == checks[first][inverse]
        whole.update(of[~same].tolist())
        whole.update(of[(place < 0)[inverse]].tolist())
        place = np.maximum(place, 0)[inverse]
        borders = np.searchsorted(of, np.arange(len(texts) + 1))
        for k, text in enumerate(texts):
            yield self._direct(text) if k in whole else self._joined(place[borders[k] : borders[k + 1]])

    def _known(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places of words in the table, -1 for those that are not there."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[place] == keys) & (self.checks[place] == checks), place, -1)

    def _joined(self, places: np.ndarray) -> np.ndarray:
        """The ids of the words at ``places``, in their order."""
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.at[places] - ends + sizes, sizes)
        return self.ids[shift + np.arange(len(shift))]

    def _direct(self, text: str | None) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids if text else [], np.uint32)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file, until the worker turns to another operator."""
    encoders = held("packing")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine; a path is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, room: int = ROOM, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's ids, cut only where longer than ``room``."""
    small_batches(docs.sparkSession, ROWS)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()  # of what other operators left in this worker
        known = encoder(tokenizer_path(tokenizer))
        try:
            yield from cut(known.encode, batches)
        finally:  # words stay known to the next task, the rest goes
            freed()

    def cut(encode, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(END)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), room)):
                    own = ids[start : start + room]
                    for column, value in zip(out, (doc, piece, start, len(own), zlib.crc32(own.tobytes()), own.view(np.int32) if with_ids else None)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 5 + with_ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Pattern:
    """Lengths that share a sequence, and the number of sequences filled like this."""

    lengths: tuple[int, ...]
    count: int


def plan(counts: dict[int, int], room: int = ROOM) -> list[Pattern]:
    """Patterns that hold every item of a histogram of lengths."""
    left = {n: c for n, c in counts.items() if c > 0}
    large = sorted((n for n in left if 3 * n > room), reverse=True)
    by_gap: dict[int, list[Pattern]] = defaultdict(list)

    def put(lengths: tuple[int, ...], count: int) -> None:
        by_gap[room - sum(lengths)].append(Pattern(lengths, count))

    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= n and m <= room - n and left[m] > (m == n)), None)
            if mate is None:
                put((n,), left[n])
                left[n] = 0
            else:
                pairs = left[n] // 2 if mate == n else min(left[n], left[mate])
                put((n, mate), pairs)
                left[n] -= pairs
                left[mate] -= pairs
    for n in sorted((n for n in left if 3 * n <= room), reverse=True):
        while left[n]:
            gap = min((g for g, own in by_gap.items() if g >= n and own), default=None)
            if gap is None:
                each = room // n
                full, rest = divmod(left[n], each)
                if full:
                    put((n,) * each, full)
                if rest:
                    put((n,) * rest, 1)
                left[n] = 0
                break
            old = by_gap[gap].pop()
            times = min(gap // n, max(1, left[n] // old.count))
            moved = min(old.count, left[n] // times)
            if moved < old.count:
                by_gap[gap].append(Pattern(old.lengths, old.count - moved))
            put(old.lengths + (n,) * times, moved)
            left[n] -= moved * times
    return [p for own in by_gap.values() for p in own]


def lookup(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length the runs of its ranks: columns first rank, items in a sequence, first sequence, offset of the first item.

    Within a pattern, equal lengths lie side by side.
    """
    at, seen, out = 0, defaultdict(int), defaultdict(list)
    for p in patterns:
        offset = 0
        for n in sorted(set(p.lengths), reverse=True):
            each = p.lengths.count(n)
            out[n].append((seen[n], each, at, offset))
            seen[n] += each * p.count
            offset += each * n
        at += p.count
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def packed(items: DataFrame, room: int = ROOM) -> DataFrame:
    """Adds sequence_id and offset to items, whose column ``length`` is 1 to ``room``.

    Ranks within a length come from one range exchange of the items over (length, all other columns), so that a
    length held by many rows is dealt to many tasks; equal rows are interchangeable. The histogram, ``room``
    counts, and the patterns, fewer than ``4 * room``, are all that the driver holds.
    """
    spark = items.sparkSession
    rows, _ = numbered(items, ["length"], "pack-items")
    counts = {r.length: r.n for r in rows.groupBy(F.col("row.length").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    first, at = {}, 0
    for n in sorted(counts):
        first[n], at = at, at + counts[n]
    shared = spark.sparkContext.broadcast((lookup(plan(counts, room)), first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, begin = shared.value
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                rank, table = number[own] - begin[n], runs[n]
                hit = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
                inside = rank - hit[:, 0]
                sequence[own] = hit[:, 2] + inside // hit[:, 1]
                offset[own] = hit[:, 3] + inside % hit[:, 1] * n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)], names=["row", "sequence_id", "offset"])

    kind = rows.schema["row"].dataType.simpleString()
    placed = rows.select("row", F.col("row.length").alias("n"), "number").mapInArrow(run, f"row {kind}, sequence_id long, offset long")
    return placed.select("row.*", "sequence_id", "offset")


def report(docs: DataFrame, room: int = ROOM, tokenizer: str = TOKENIZER) -> DataFrame:
    """The place of every piece of every row of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one: a piece of one id. Null and repeated ids are documents like others. Other
    columns are ignored. An empty table gives an empty result.
    """
    found = written(pieces(docs, room, tokenizer), "pack-pieces")
    return packed(found, room)


def sequences(docs: DataFrame, room: int = ROOM, tokenizer: str = TOKENIZER) -> DataFrame:
    """The sequences themselves: sequence_id, ids, and the offsets at which their pieces begin."""
    found = written(pieces(docs, room, tokenizer, with_ids=True), "pack-pieces")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed(found, room).groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("offsets")
    )
