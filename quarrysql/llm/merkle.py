"""Merkle manifest of a dataset with incremental witnesses.

Leaves of a source are appended in order to a tree of runs of three. A node that waits for its run to fill is an open
subtree, and carries the partial witnesses of all leaves below it; when the run is complete, each of them is extended by
the siblings of its subtree, and the parent is appended one level higher. On a cluster the leaves are cut into aligned blocks
of 3 ** HEIGHT, and each block is a stream of its own; the roots of blocks are then appended in the same way, with their place in
the source, until every source has one root, and at last the roots of sources. A witness of a leaf is its witness in the block,
then that of the block's root, and so on.

A witness is packed into bytes: for each level one byte, 4 * place + siblings, and the digests of the siblings from left to right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import fold, local, small_batches
from quarrysql.session import written

ARITY = 3
#: Levels of a block: 3 ** 5 = 243 leaves, so that any source, however large, is dealt out to many tasks.
HEIGHT = 5
SIZE = 32


def joined_digest(parts: list[bytes]) -> bytes:
    """The digest of digests, which enter as lowercase hex."""
    return hashlib.sha256(b"".join([p.hex().encode() for p in parts])).digest()


class Witnesses:
    """A tree that grows by appends at its right edge, and the witnesses of its leaves.

    ``open[k]`` is the run of level k that is not full yet: for each node its digest and its leaves.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, range]]] = []
        self.paths: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        self.paths.append(bytearray())
        self._put(0, digest, range(len(self.paths) - 1, len(self.paths)))

    def _put(self, level: int, digest: bytes, leaves: range) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, leaves))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The run of a level becomes one node; the witnesses of every node in it gain the others."""
        run, self.open[level] = self.open[level], []
        for place, (_, leaves) in enumerate(run):
            gained = bytes([4 * place + len(run) - 1]) + b"".join(d for k, (d, _) in enumerate(run) if k != place)
            for leaf in leaves:
                self.paths[leaf] += gained
        self._put(level + 1, joined_digest([d for d, _ in run]), range(run[0][1].start, run[-1][1].stop))

    def close(self, height: int | None) -> bytes:
        """Ends the appends and gives the root: ``height`` levels up, or (None) where one node remains."""
        level = 0
        while True:
            above = any(self.open[level + 1 :])
            if level == height or (height is None and not above and len(self.open[level]) == 1):
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The levels of a witness: the place of the own node in its run, and the digests of the others."""
    at = 0
    while at < len(witness):
        place, others = divmod(witness[at], 4)
        yield place, [witness[k : k + SIZE] for k in range(at + 1, at + 1 + others * SIZE, SIZE)]
        at += 1 + others * SIZE


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and a witness lead to."""
    for place, others in steps(witness):
        leaf = joined_digest([*others[:place], leaf, *others[place:]])
    return leaf


def proof(witness: bytes) -> bytes:
    """One digest of all siblings of a witness, in its order."""
    return joined_digest([d for _, others in steps(witness) for d in others])


def field(value: Column) -> Column:
    """A value as bytes: its length, a colon and itself, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")).cast("binary")


def leaf(fields: list[Column]) -> Column:
    """The digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(f) for f in fields]), 256))


def _ordered(rows: DataFrame, label: str) -> DataFrame:
    """Adds ``g``, the number of the source among all sources, and ``p``, the place of the row in its source, both from 0.

    ``rows``: source, key, digest and more. One range exchange sorts by source, key and digest; each task numbers what it
    holds, and one row for each task (first source, last source, how many) tells the others where they begin. Equal rows are
    interchangeable, so their sort key ends with a number of their own, and a range may cut a group of them.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["source", "key", "digest", "tie"]
    kinds = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, g, p = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("source").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new = np.ones(len(codes), bool)
            new[1:] = codes[1:] != codes[:-1]
            first = batch.column("source")[0].as_py()
            new[0] = g < 0 or first != last
            run_of = np.cumsum(new)  # 0: goes on with the source of the batch before
            begin = np.flatnonzero(new)
            starts = np.concatenate([[-p], begin])[run_of]
            places = np.arange(len(codes)) - starts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part, np.int32)), pa.array(g + run_of), pa.array(places.astype(np.int64))],
                names=[*batch.schema.names, "part", "g", "p"],
            )
            last, g, p = batch.column("source")[-1].as_py(), int(g + run_of[-1]), int(places[-1]) + 1

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
    small_batches(spark)
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
    kept = written(ranged.mapInArrow(run, f"{own}, part int, g bigint, p bigint"), label)
    here = F.struct("g", "p", "source")
    edges = kept.groupBy("part").agg(F.min(here).alias("first"), F.max(here).alias("last")).orderBy("part").collect()  # one row a task
    carry, source, g, p = [], None, -1, 0
    for e in edges:
        goes_on = g >= 0 and e.first.source == source
        base = g if goes_on else g + 1
        carry.append((e.part, base, p if goes_on else 0))
        p = e.last.p + 1 + (p if goes_on and e.last.g == 0 else 0)
        source, g = e.last.source, base + e.last.g
    begins = local(spark, carry, "part int, base long, before long")
    return kept.join(F.broadcast(begins), "part").select(
        *rows.columns, (F.col("base") + F.col("g")).alias("g"), (F.col("p") + F.when(F.col("g") == 0, F.col("before")).otherwise(0)).alias("p")
    )


def _blocks(nodes: DataFrame, height: int, label: str) -> DataFrame:
    """Streams each block of ``nodes`` (g, p, digest, row) into a tree.

    Returns the nodes with ``witness``, their witness in the block, and for each block one row without ``witness``: g, p the number of
    the block, digest its root. Block 0 of a source, if it is not full, is the whole source: its tree ends where one node
    remains. Any other block climbs ``height`` levels, as its nodes do beside those of full blocks.
    """
    full = ARITY**height
    kind = nodes.schema["row"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def finished(table: pa.Table, borders: np.ndarray) -> Iterator[pa.RecordBatch]:
            g, p = table["g"].to_numpy(), table["p"].to_numpy()
            digests = table["digest"].to_pylist()
            paths: list[bytearray] = []
            roots: list[tuple[int, int, bytes]] = []
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                tree = Witnesses()
                for d in digests[a:b]:
                    tree.append(d)
                block = int(p[a]) // full
                root = tree.close(None if block == 0 and b - a < full else height)
                roots.append((int(g[a]), block, root))
                paths += tree.paths
            out = table.append_column("witness", pa.array([bytes(w) for w in paths], pa.binary()))
            yield from out.combine_chunks().to_batches()
            columns = list(zip(*roots))
            row = pa.nulls(len(roots), out.schema.field("row").type)
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), row, pa.nulls(len(roots), pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=out.schema)

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
                g, block = table["g"].to_numpy(), table["p"].to_numpy() // full
                begins = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (block[1:] != block[:-1])]))
                if len(begins) > 1:
                    yield from finished(table.slice(0, int(begins[-1])), begins)
                waiting = table.slice(int(begins[-1])).to_batches()
        if waiting:
            table = pa.Table.from_batches(waiting).combine_chunks()
            yield from finished(table, np.array([0, table.num_rows]))

    small_batches(nodes.sparkSession)
    dealt = nodes.select("g", "p", "digest", "row").repartition(F.col("g"), F.floor(F.col("p") / full)).sortWithinPartitions("g", "p")
    return written(dealt.mapInArrow(run, f"g bigint, p bigint, digest binary, row {kind.simpleString()}, witness binary"), label)


def witnesses(nodes: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """The witnesses of nodes (g, p, digest, row) up to the root of their group g, and the roots.

    Returns (g, p, digest, row, witness) and (g, digest). Places p of a group run from 0 without gaps. Each pass over the
    roots of blocks has 3 ** height times fewer nodes; a pass more is made while any group has several blocks.
    """
    full = ARITY**height
    made = _blocks(nodes, height, "merkle-blocks")
    own, tops = made.where("witness IS NOT NULL"), made.where("witness IS NULL").select("g", "p", "digest", "row")
    if not (tops.agg(F.max("p")).first()[0] or 0):  # one block a group
        return own, tops.select("g", "digest")
    above, roots = witnesses(tops, height)
    above = above.select("g", F.col("p").alias("block"), F.col("witness").alias("above"))
    whole = own.withColumn("block", F.floor(F.col("p") / full)).join(above, ["g", "block"])
    return whole.select("g", "p", "digest", "row", F.concat("witness", "above").alias("witness")), roots


def manifest(docs: DataFrame, fields: list[str], order: str = "doc_id", group: str = "source", keep: dict[str, Column] | None = None):
    """The witness of every row of ``docs`` up to the root of the whole table.

    Returns (row, g, p, digest, witness, subroot) and the root, None for an empty table. ``row`` holds the columns ``keep``, by name; g is
    the number of the row's group, p its place in the group, digest its leaf. Groups are ordered by value, null first, rows by ``order``,
    nulls first, and then by leaf. Repeated rows are leaves of their own. Other columns may have any names.
    """
    keep = keep or {order: F.col(order)}
    leaves = docs.select(
        F.col(group).cast("string").alias("source"), F.col(order).alias("key"), leaf([F.col(f) for f in fields]).alias("digest"),
        F.struct(*[c.alias(n) for n, c in keep.items()]).alias("row"),
    )
    placed = _ordered(written(leaves, "merkle-leaves"), "merkle-ordered")
    own, subroots = witnesses(placed)
    subroots = written(subroots, "merkle-subroots")
    tops, roots = witnesses(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("p"), "digest", F.struct(F.lit(None).cast("int")).alias("row")))
    top = tops.select(F.col("p").alias("g"), F.col("digest").alias("subroot"), F.col("witness").alias("above"))
    root = roots.select("digest").first()
    return own.join(top, "g").select("row", "g", "p", "digest", F.concat("witness", "above").alias("witness"), "subroot"), root and bytes(root[0])


def _checked(digest: str, witness: str) -> Column:
    """A struct (root, proof) of hex digests: the root that a leaf and a witness lead to, and the digest of the siblings."""
    kind = pa.struct([("root", pa.string()), ("proof", pa.string())])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for leaves, paths in batches:
            found = [(folded(d, w).hex(), proof(w).hex()) for d, w in zip(leaves.to_pylist(), paths.to_pylist())]
            columns = list(zip(*found)) or [(), ()]
            yield pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], fields=list(kind))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<root: string, proof: string>")(F.col(digest), F.col(witness))


#: The columns of a leaf, in their order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def report(docs: DataFrame) -> DataFrame:
    """Leaf, roots, digest of the witness, and whether each row, after tampering, still leads to the root.

    Every second row by crc32 of its id, as text, loses the line feeds of its text before it is checked; a null id is never
    tampered with, and a text without line feeds, or null, stays what it is. An empty table gives an empty result.
    """
    docs = docs.select(*FIELDS)
    cut = F.when(fold("doc_id", 2) == 0, leaf([F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS]))
    found, root = manifest(docs, FIELDS, keep={"doc_id": F.col("doc_id"), "tampered": cut})
    seen = found.select(
        "row.doc_id", "digest", "subroot", "witness", F.coalesce("row.tampered", "digest").alias("presented")
    ).withColumn("check", _checked("presented", "witness"))
    hexed = lambda c: F.lower(F.hex(c))
    stated = F.lit(root.hex() if root else None).cast("string")
    return seen.select(
        "doc_id", hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"), stated.alias("root"), F.col("check.proof").alias("proof_sha256"),
        F.col("check.root").alias("folded_root"), (F.col("check.root") == stated).alias("verified"),
    )
