"""Circulant MinHash: near-duplicate texts by banding, each link confirmed on the full shingle sets.

Two permutations make all coordinates of a signature: the first scatters the shingles over a circle of 2**32
places, the second ranks the places; coordinate k ranks them after a turn by k places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from quarrysql.llm.common import freed, held, small_batches
from quarrysql.llm.components import components
from quarrysql.session import written

#: A pair of similarity 0.8 shares none of 30 bands of 5 coordinates once in about 150,000 times.
BANDS, ROWS = 30, 5
#: Of the last bits of two signatures' coordinates, at most so many differ: of the 150 bits of a pair of similarity 0.8
#: fifteen do on average, and more than 36 once in a million times. Pairs beyond it are not worth a look at the sets.
APART = 36
#: Bits of the odd sketch of a set: bit k tells whether an odd number of its shingles fall on k.
ODD = 1_024
#: Shingles ranked at a time.
BLOCK = 2_048
#: A list of text hashes up to this size is broadcast to the scan; beyond it the scan is joined by exchange.
BROADCAST_KEYS = 2_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word shingles; fewer words make one shingle, no words none."""
    own = (text or "").encode().lower().split()
    if not own:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, own), np.uint64, len(own))
    width = min(width, len(own))
    out = np.full(len(own) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(own) - width + 1 + k])
    return np.unique(out)


def signature(found: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Smallest rank of the shingles' places after each of ``size`` turns of the circle."""
    places = (mix64(found ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    turns = np.arange(size, dtype=np.uint32)[:, None]
    best = np.full(size, np.uint32(0xFFFFFFFF), np.uint32)
    for at in range(0, len(places), BLOCK):
        x = places[None, at : at + BLOCK] + turns
        y = x >> np.uint32(16)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x85EBCA6B), out=x)
        np.right_shift(x, np.uint32(13), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0xC2B2AE35), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        np.minimum(best, x.min(axis=1), out=best)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return keys.view(np.int64)


def last_bits(sig: np.ndarray) -> np.ndarray:
    """The last bit of each coordinate, in three 64-bit numbers."""
    bits = np.zeros(192, np.uint8)
    bits[: len(sig)] = sig & np.uint32(1)
    return np.packbits(bits).view(np.int64)


def odd_bits(found: np.ndarray) -> np.ndarray:
    """The odd sketch of a set, in 64-bit numbers."""
    at = ((found >> np.uint64(20)) % np.uint64(ODD)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=ODD) & 1).astype(np.uint8)).view(np.int64)


def apart(a: str, b: str, longs: int) -> Column:
    """How many bits of two columns of ``longs`` 64-bit numbers differ."""
    return reduce(add, (F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(longs)))


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether two classes can be alike, from the columns n, bits and odd of the structs ``a`` and ``b``.

    The sizes and the odd sketches never refuse a link: where two sketches differ, the sets differ in a shingle
    of that place, and sets that are alike differ in at most (100 - percent) / (100 + percent) of their sizes' sum.
    The last bits settle long texts, whose odd sketches are full.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    fits = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    fits = fits & ((100 + percent) * apart(f"{a}.odd", f"{b}.odd", ODD // 64) <= (100 - percent) * (n + m))
    return fits & (apart(f"{a}.bits", f"{b}.bits", 3) <= APART) if percent >= 80 else fits


def set_key(found: np.ndarray) -> bytes:
    """16 bytes that name a set of shingles."""
    a = mix64(found).sum(dtype=np.uint64) + np.uint64(len(found))
    b = np.bitwise_xor.reduce(mix64(found + np.uint64(0x632BE59BD9B4E019)))
    return np.array([a, b], np.uint64).tobytes()


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, on whole sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls, bands, bits, odd) of each row; the last four are null for a text without words."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("minhash")
        for batch in batches:
            sizes, keys, bands, bits, odd, seen = [], [], [], [], [], {}
            for text in batch.column(2).to_pylist():
                if text not in seen:
                    found = shingles(text, width)
                    sig = signature(found)
                    seen[text] = (len(found), set_key(found), band_keys(sig), last_bits(sig), odd_bits(found)) if len(found) else (0, None, None, None, None)
                for out, value in zip((sizes, keys, bands, bits, odd), seen[text]):
                    out.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (bands, bits, odd))],
                names=["doc_id", "text_hash", "n_shingles", "cls", "bands", "bits", "odd"],
            )
        freed()

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, cls binary, bands array<long>, bits array<long>, odd array<long>"
    )


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are alike, from the whole text of one row of each class."""
    spark = docs.sparkSession
    wanted = (
        pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes, "cls").select("cls", "rep.*")
    )
    wanted = written(wanted, "minhash-wanted")
    hashes = wanted.select("text_hash").distinct()
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text")
    if hashes.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(hashes), F.col("h") == F.col("text_hash"), "left_semi")
    texts = texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash"))).select("cls", "text")
    texts = written(texts.dropDuplicates(["cls"]), "minhash-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("minhash")
        last, known = None, None
        for batch in batches:
            keep = []
            for i, (a, x, y) in enumerate(zip(batch.column("a").to_pylist(), batch.column("x"), batch.column("y"))):
                if a != last:
                    last, known = a, shingles(x.as_py(), width)
                if alike(known, shingles(y.as_py(), width), percent):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
        freed()

    small_batches(spark)
    both = (
        pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("y")), "b")
        .join(texts.select(F.col("cls").alias("a"), F.col("text").alias("x")), "a")
        .select("a", "b", "x", "y")
    )
    return written(both.mapInArrow(run, "a binary, b binary"), "minhash-links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Every row's component of near-duplicate texts: (doc_id, text_hash, n_shingles, cls, component_id, kept).

    * Rows with one set of shingles are one class; all further work is on classes.
    * In each bucket of a band every class is held against the one with the most company, and links join components. Then
      come rounds: in each bucket that still holds several components, a few classes from outside its largest
      component, 32 times as many in each round, are held against all classes of other components; links join
      components again. A bucket is done when every class outside its largest component has had its turn, since components only
      grow; later rounds look at the other buckets alone, and the rounds end when none is left. So no pair
      that shares a band goes untested, unless one component, the sizes or the sketches settle it, and a bucket of copies costs
      its size, not its square.
    * component_id is the smallest id of the component; null ids are larger than all others, and a component
      of null ids alone has a null component_id. A text that is null or has no words is its own component.
      kept is true where doc_id = component_id (both null included). Rows that repeat an id are documents of
      their own: linked by text alone.
    * Extra columns are ignored, whatever their names. An empty table gives an empty result.
    """
    base = written(sketches(docs, width), "minhash-sketches")
    classes = written(
        base.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("rep"),
            F.count(F.lit(1)).alias("rows"),
            F.first(F.struct(F.col("n_shingles").alias("n"), "bits", "odd")).alias("sketch"),
            F.first("bands").alias("bands"),
        ),
        "minhash-classes",
    )
    reps, drawn = classes.select("cls", "rep"), classes.select("cls", "sketch")

    def known(pairs: DataFrame) -> DataFrame:
        """The pairs that the sketches do not refuse."""
        both = pairs.join(drawn.toDF("a", "x"), "a").join(drawn.toDF("b", "y"), "b")
        return both.where(may_link("x", "y", percent)).select("a", "b")

    placed = classes.select("cls", F.explode("bands").alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = written(placed.join(sizes, "bucket"), "minhash-shared")
    # The text that others were copied from shares the most buckets; it is the best one to hold them against.
    score = shared.groupBy("cls").agg(F.sum("size").alias("score"))
    members = written(shared.join(score, "cls").select("bucket", "cls", "score"), "minhash-members")
    first = members.groupBy("bucket").agg(F.max(F.struct("score", "cls")).alias("first"))
    tested = members.join(first, "bucket").where(F.col("cls") != F.col("first.cls"))
    tested = tested.select(F.least("first.cls", "cls").alias("a"), F.greatest("first.cls", "cls").alias("b")).distinct()
    tested = written(known(tested), "minhash-tested")
    links = confirmed(docs, reps, tested, width, percent)
    groups = components(links, "minhash-groups")

    links, leaders = groups.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")), 1
    led, seen = None, tested
    while True:
        # Only buckets whose turns are not over; the first round looks at all.
        marked = members.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select("bucket", "cls", "score", F.coalesce("component", "cls").alias("comp"))
        marked = written(marked, "minhash-marked")
        mixed = (
            marked.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
            .agg(F.max(F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
            .where("comps > 1").select("bucket", F.col("main.comp").alias("main"))
        )
        marked = written(marked.join(mixed, "bucket").join(drawn, "cls"), "minhash-mixed")
        stray = marked.where("comp != main")
        stray = stray if led is None else stray.join(led, ["bucket", "cls"], "left_anti")
        rest = stray.groupBy("bucket").agg(F.count(F.lit(1)).alias("strays")).where(F.col("strays") > leaders).select("bucket")
        members = marked.select("bucket", "cls", "score").join(rest, "bucket", "left_semi")
        turn = Window.partitionBy("bucket").orderBy(F.desc("score"), "cls")
        now = written(stray.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= leaders), "minhash-leaders")
        if now.isEmpty():
            break
        led = now.select("bucket", "cls") if led is None else led.unionByName(now.select("bucket", "cls"))
        across = (
            now.select("bucket", F.col("cls").alias("s"), F.col("comp").alias("s_comp"), F.col("sketch").alias("s_sketch"))
            .join(marked.select("bucket", "cls", "comp", "sketch"), "bucket")
            .where((F.col("comp") != F.col("s_comp")) & may_link("sketch", "s_sketch", percent))
            .select(F.least("s", "cls").alias("a"), F.greatest("s", "cls").alias("b")).distinct()
            .join(seen, ["a", "b"], "left_anti")
        )
        across = written(across, "minhash-across")
        if not across.isEmpty():
            seen = seen.unionByName(across)
            more = confirmed(docs, reps, across, width, percent)
            if not more.isEmpty():
                links = written(links.unionByName(more), "minhash-links")
                groups = components(links, "minhash-groups")
        leaders *= 32

    labelled = classes.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "rows", "rep", F.coalesce("component", "cls").alias("comp"), F.col("component").isNotNull().alias("linked")
    )
    least = labelled.where("linked").groupBy("comp").agg(F.min("rep").alias("least"))
    named = (
        labelled.where("linked OR rows > 1").join(least, "comp", "left")
        .select("cls", F.coalesce("least", "rep").alias("least"))
    )
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    return (
        base.join(named, "cls", "left")
        .withColumn("least", F.coalesce("least", own))
        .select("doc_id", "text_hash", "n_shingles", "cls", F.col("least.doc_id").alias("component_id"), "least")
        .select("doc_id", "text_hash", "n_shingles", "cls", "component_id", "least", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, all columns kept.

    The row is the one with the smallest id (null last), then the smallest text hash. Rows without words
    stay. Rows equal in id and text count as one; of them the smallest in all columns stays.
    """
    found = near_duplicates(docs, width, percent)
    keys = (
        found.groupBy("doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("stays"))
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), "n", "stays")
    )
    keys = written(keys.where("n > 1 OR NOT stays"), "minhash-keys")
    gone, repeated = keys.select("id", "h"), keys.where("n > 1 AND stays").select("id", "h")
    if gone.count() <= BROADCAST_KEYS:
        gone, repeated = F.broadcast(gone), F.broadcast(repeated)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("hash"))
    match = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h"))
    single = rows.join(gone, match, "left_anti").select("row")
    first = rows.join(repeated, match, "left_semi").groupBy(F.col("row.doc_id").alias("id"), "hash").agg(F.min("row").alias("row"))
    return single.unionByName(first.select("row")).select("row.*")
