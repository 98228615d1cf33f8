"""Approximate nearest neighbours by collision counting.

Every hash function is a single projection on a random line; its index is the block's vectors sorted by projection. A
query opens a window around its own projection on each line. A vector inside the windows of enough lines has collided often
enough to be verified: its exact inner product is computed. The windows grow by a fixed ratio (virtual rehashing: the
arrays stay, only the ends move) until the query's k-th best distance is within the radius that the windows stand for.
Collisions are counted on bits, for many queries at a time: a window is the difference of two prefixes of a sorted array.

Largest inner product becomes nearest distance by one more component, which gives all vectors the norm of the longest.

The lines are drawn from a seed; nothing is fitted. Every row is indexed. Rows are dealt to blocks of about BLOCK
rows, queries to groups of about QUERIES, and each group meets each block.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.llm.vectors import stacked, usable
from quarrysql.session import written

#: Lines, windows a vector has to be in, first half width in units of the longest norm, and growth of the windows.
LINES, COLLISIONS, FIRST, GROWTH = 48, 29, 0.7, 1.2
BLOCK, QUERIES = 16_384, 512
#: Queries whose collisions are counted together, and bits of the prefixes of a line.
TOGETHER, PREFIX_BITS = 64, 1 << 22
SEED = 20_240_607


def lines(dim: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, LINES))


def dot(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component to the last, so that equal vectors have equal scores."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as bits, in whole 64-bit numbers."""
    out = np.zeros((len(rows), -(-rows.shape[1] // 64)), np.uint64)
    packed = np.packbits(rows, axis=1)
    out.view(np.uint8)[:, : packed.shape[1]] = packed
    return out


class Index:
    """The sorted projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, longest: float) -> None:
        self.vectors, self.longest = vectors, longest
        rest = np.sqrt(np.maximum(0.0, longest**2 - np.square(vectors).sum(axis=1)))
        self.lines = lines(vectors.shape[1] + 1)
        spread = vectors @ self.lines[:-1] + rest[:, None] * self.lines[-1]
        order = np.argsort(spread, axis=0, kind="stable")
        self.sorted = np.take_along_axis(spread, order, axis=0).T.copy()
        # Prefixes of each sorted array, a bit for each vector: the t-th tells which of them lie before place t * step.
        self.step = -(-len(vectors) // max(1, min(len(vectors), PREFIX_BITS // len(vectors))))
        shape = (LINES, -(-len(vectors) // self.step) + 1, -(-len(vectors) // 64))
        self.prefixes = np.zeros(shape, np.uint64)
        row = np.arange(len(vectors))
        for j, own in enumerate(self.prefixes):
            run = np.empty(len(vectors), np.int64)
            run[order[:, j]] = row // self.step + 1
            np.add.at(own.view(np.uint8).reshape(-1), run * (8 * shape[2]) + (row >> 3), (128 >> (row & 7)).astype(np.uint8))
            np.bitwise_or.accumulate(own, axis=0, out=own)

    def collisions(self, at: np.ndarray, half: float) -> np.ndarray:
        """For each query a bit for each vector: whether it is within the query's windows on COLLISIONS lines.

        A window is the difference of two prefixes, its ends moved outward to the next border of a run. Bits of all lines are summed by
        adders: the n-th list holds numbers whose bits stand for 2**n collisions.
        """
        weights: list[list[np.ndarray]] = [[] for _ in range(LINES.bit_length())]

        def add(bits: np.ndarray, n: int) -> None:
            own = weights[n]
            own.append(bits)
            if len(own) == 3:
                x, y, z = own
                either = x ^ y
                weights[n] = [either ^ z]
                add((x & y) | (either & z), n + 1)

        for j in range(LINES):
            low = self.sorted[j].searchsorted(at[:, j] - half) // self.step
            high = -(-self.sorted[j].searchsorted(at[:, j] + half, side="right") // self.step)
            add(self.prefixes[j, high] ^ self.prefixes[j, low], 0)
        enough = np.full_like(self.prefixes[0, :1], ~np.uint64(0))
        for n, own in enumerate(weights):
            bit = own[0] if own else np.zeros_like(enough)
            if len(own) == 2:
                add(own[0] & own[1], n + 1)
                bit = own[0] ^ own[1]
            enough = bit & enough if COLLISIONS >> n & 1 else bit | enough
        return enough

    def search(self, queries: np.ndarray, k: int, own: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query places and scores of the (at least, where there are so many) ``k`` best rows found, ties at the end included.

        ``own`` holds the place of each query's own row, -1 where it is elsewhere.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for first in range(0, len(queries), TOGETHER):
            out += self._search(queries[first : first + TOGETHER], k, own[first : first + TOGETHER])
        return out

    def _search(self, queries: np.ndarray, k: int, own: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        n, half = len(self.vectors), FIRST * self.longest
        at = queries @ self.lines[:-1]
        fresh = np.tile(_bits(np.ones((1, n), bool)), (len(queries), 1))
        for bits, place in zip(fresh.view(np.uint8), own):
            if place >= 0:
                bits[place >> 3] &= np.uint8(255 ^ (128 >> (place & 7)))
        left = [n - (place >= 0) for place in own]
        need = [min(k, x) for x in left]
        places, scores = [np.empty(0, np.int64) for _ in own], [np.empty(0) for _ in own]
        base = np.array([float(q @ q) for q in queries]) + self.longest**2
        live = np.flatnonzero(need)
        while len(live):
            met = self.collisions(at[live], half) & fresh[live]
            fresh[live] ^= met
            still = []
            for i, bits in zip(live.tolist(), met.view(np.uint8)):
                new = np.flatnonzero(np.unpackbits(bits, count=n).view(bool))
                left[i] -= len(new)
                places[i] = np.concatenate([places[i], new])
                scores[i] = np.concatenate([scores[i], self.vectors[new] @ queries[i]])
                if len(places[i]) >= need[i]:
                    kth = np.partition(scores[i], len(scores[i]) - need[i])[len(scores[i]) - need[i]]
                    near = scores[i] >= kth - 1e-9 * max(1.0, abs(kth))
                    places[i], scores[i] = places[i][near], scores[i][near]
                    if half >= np.sqrt(max(0.0, base[i] - 2 * kth)):
                        continue
                if left[i]:
                    still.append(i)
            live = np.array(still, np.int64)
            half *= GROWTH
        return [(found, dot(self.vectors[found], query)) for found, query in zip(places, queries)]


def nearest(df: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """The ``k`` nearest rows found for each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision on the vectors as they are; ties go to the smaller vec_id, null last. Candidates are
    all rows with a vector of the query's length but its own row; rows that ``usable`` leaves out take no part on either side. A null
    vec_id is never a query. Rows that repeat an id are queries and candidates of their own. With fewer than k
    candidates all are returned. Other columns are ignored. An empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = usable(df.select("vec_id", "embedding")).select("vec_id", "v", F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "ann-rows")
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(is_query.cast("long")).alias("q"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("square"),
    ).first()
    longest = float(np.sqrt(seen.square or 0.0))
    blocks, groups = max(1, -(-seen.n // BLOCK)), max(1, -(-(seen.q or 0) // QUERIES))
    deal = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("length", F.size("v"))
    held = rows.withColumn("block", deal(blocks, 1)).withColumn("group", each(groups))
    asked = rows.where(is_query).withColumn("group", deal(groups, 2)).withColumn("block", each(blocks))

    def run(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["query_row", "query_id", "row", "vec_id", "score"]
        if not len(block) or not len(queries):
            return pd.DataFrame({c: [] for c in names})
        block = block.sort_values("row").reset_index(drop=True)
        index, place = Index(stacked(block.v), longest), {r: i for i, r in enumerate(block.row)}
        ids, own = block.vec_id.to_numpy(), block.row.to_numpy()
        found = index.search(stacked(queries.v), k, [place.get(r, -1) for r in queries.row])
        best = [places[np.lexsort((own[places], ids[places], -scores))[:k]] for places, scores in found]
        best_scores = [np.sort(-scores)[:k] * -1.0 for _, scores in found]
        sizes, at = [len(b) for b in best], np.concatenate(best)
        columns = [np.repeat(queries.row.to_numpy(), sizes), np.repeat(queries.vec_id.to_numpy(), sizes), own[at], ids[at], np.concatenate(best_scores)]
        return pd.DataFrame(dict(zip(names, columns)))

    found = held.groupBy("length", "block", "group").cogroup(asked.groupBy("length", "block", "group")).applyInPandas(
        run, "query_row long, query_id long, row long, vec_id long, score double"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
