"""Fill-in-middle transformation by in-place block rotation.

A text is cut into prefix, middle and suffix at two places that its id decides. The buffer first holds the parts in
their own order, each behind its sentinel: <P>prefix<M>middle<S>suffix. One exchange of two neighbouring blocks, three
reversals in place, makes either form of it: psm swaps the last two blocks, spm brings the last block to the front. The same
exchange backwards, found from the sentinels alone, and dropping them give the text back exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import small_batches, text_of

#: What stands before prefix, suffix and middle.
P, S, M = b"<P>", b"<S>", b"<M>"
#: Of 100 texts, so many are transformed, and of 100 of those, so many in the order suffix, prefix, middle.
RATE, SPM = 90, 20
#: Bytes that are scanned for code points at a time.
SCAN = 1 << 20


def rotate(buffer: bytearray, begin: int, border: int, end: int) -> None:
    """Exchanges the blocks begin..border and border..end in place."""
    for a, b in ((begin, border), (border, end), (begin, end)):
        buffer[a:b] = buffer[a:b][::-1]


def _leads(line: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each stretch of a text, where it begins and which of its bytes begin a code point."""
    for at in range(0, len(line), SCAN):
        yield at, (line[at : at + SCAN] & 0xC0) != 0x80


def code_points(text: bytes) -> int:
    return sum(int(np.count_nonzero(lead)) for _, lead in _leads(np.frombuffer(text, np.uint8)))


def byte_places(text: bytes, points: tuple[int, ...]) -> list[int]:
    """The byte at which each code point begins; the place after the last one is the length in bytes."""
    seen, found = 0, dict.fromkeys(points, len(text))
    for at, lead in _leads(np.frombuffer(text, np.uint8)):
        here = int(np.count_nonzero(lead))
        for k in found:
            if seen <= k < seen + here:
                found[k] = at + int(np.flatnonzero(lead)[k - seen])
        seen += here
    return [found[k] for k in points]


def transformed(key: bytes, text: bytes, rate: int = RATE, spm: int = SPM) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, code points of prefix, of middle, output) of one text; plain texts have no parts."""
    n = code_points(text)
    digest = hashlib.sha256(b"1:" + key).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not n or h3 % 100 >= rate or any(mark in text for mark in (P, S, M)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = byte_places(text, (first, second))
    buffer = bytearray(text)
    for place, mark in ((b, S), (a, M), (0, P)):  # from behind, so that the places still hold
        buffer[place:place] = mark
    middle, suffix = a + len(P), b + len(P) + len(M)
    form = "spm" if h4 % 100 < spm else "psm"
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return n, form, first, second - first, bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text, from output and form. A sentinel cannot lie across a border of parts, so the first hit is the one set."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    suffix, middle, end = buffer.find(S), buffer.find(M), len(buffer)
    if form == "psm":  # prefix, suffix, middle: the middle back before the suffix
        rotate(buffer, suffix, middle, end)
    else:  # suffix, prefix, middle: the suffix back behind the others
        rotate(buffer, 0, buffer.find(P), end)
    for mark in (P, M, S):
        place = buffer.find(mark)
        del buffer[place : place + len(mark)]
    return bytes(buffer)


_PARTS = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: binary>"
_ARROW = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])


def fim(key: str = "doc_id", text: str = "text", rate: int = RATE, spm: int = SPM) -> Column:
    """A struct (n, form, prefix_chars, middle_chars, output) for each whole text; output is UTF-8 bytes.

    A null text is an empty one, which stays plain; a null id counts as an id without digits. Each row is
    transformed by itself: repeated rows alike, a table without rows to none. No other column is read, so any names may occur.
    """

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, texts in batches:
            found = [transformed(k, t, rate, spm) for k, t in zip(keys.to_pylist(), texts.to_pylist())]
            columns = list(zip(*found)) or [()] * len(_ARROW)
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], fields=list(_ARROW))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    ids = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.arrow_udf(run, _PARTS)(ids, text_of(text).cast("binary"))


def original(output: Column, form: Column) -> Column:
    """The texts as bytes, from outputs and forms; null where the output is null."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            yield pa.array([None if o is None else restored(o, f) for o, f in zip(outputs.to_pylist(), forms.to_pylist())], pa.binary())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(output, form)


def with_fim(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "fim", rate: int = RATE, spm: int = SPM) -> DataFrame:
    """All columns of ``docs`` and the struct of ``fim`` as ``name``, which must not be a column yet."""
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    small_batches(docs.sparkSession)
    return docs.withColumn(name, fim(key, text, rate, spm))


def report(docs: DataFrame) -> DataFrame:
    """Lengths, form and digests of each row: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    Digests are of the operator's own output, and of the text rebuilt from that and the form.
    """
    made = with_fim(docs.select("doc_id", "text"))
    back = original(F.col("fim.output"), F.col("fim.form"))
    return made.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2(F.col("fim.output"), 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
