"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

Two unit vectors of cosine c or more lie within r = sqrt((1 - c) / 2) of the middle between them. So a vector belongs
not only to its own cell but to every cell whose centre it nearly prefers: those where its product is lower than with
its best centre by at most r times the distance of the two centres. The cell of the middle has both vectors, and no
pair is lost at a border. A pair that shares several cells counts in the first of them.

Equal vectors of one label are one class, with the number of its rows; all products are between classes.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.components import components
from quarrysql.llm.vectors import stacked, usable
from quarrysql.session import written

LEAST = 0.98
#: Vectors that the centres are fitted on, at most; rounds; classes in a cell on average; most centres.
SAMPLE, ROUNDS, PER_CELL, CENTRES = 20_000, 8, 1_024, 1_024
#: Classes of a cell that one task holds on either side.
BLOCK = 2_048
#: Rounding of double products; far below any difference that matters to a cell.
SLACK = 1e-9


def centres(vectors: np.ndarray, k: int) -> np.ndarray:
    """``k`` unit centres by spherical k-means from the first ``k`` vectors."""
    c = vectors[:k].copy()
    for _ in range(ROUNDS):
        own = (vectors @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def cells(vectors: np.ndarray, c: np.ndarray, least: float) -> np.ndarray:
    """Which cells each unit vector belongs to, as booleans."""
    products = vectors @ c.T
    best = products.argmax(axis=1)
    apart = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2) if len(c) <= 256 else np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
    reach = math.sqrt(max(0.0, (1 - least) / 2))
    return products.max(axis=1, keepdims=True) - products <= reach * apart[best] + SLACK


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def groups(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the smallest row that links reach."""
    group = np.full(len(linked), -1)
    for start in range(len(linked)):
        front = np.array([start]) if group[start] < 0 else np.empty(0, int)
        while len(front):
            group[front] = start
            front = np.flatnonzero(linked[front].any(axis=0) & (group < 0))
    return group


def compared(cell: int, left: pd.DataFrame, right: pd.DataFrame | None, least: float) -> pd.DataFrame:
    """Links between two blocks of a cell, or (``right`` None) within one: (cls, n, root).

    n counts the rows of the classes that a class links with; root is a class that it reaches within the blocks.
    """
    one = right is None
    right = left if one else right
    x, y = stacked(left.v), stacked(right.v)
    cosine = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :])
    linked = cosine >= least
    if cell and linked.any():  # a pair counts in the first of the cells that it shares
        before = [np.zeros((len(side), cell), np.float32) for side in (left, right)]
        for marks, side in zip(before, (left, right)):
            for row, own in enumerate(side.cells):
                marks[row, own[own < cell]] = 1
        linked &= before[0] @ before[1].T == 0
    if one:
        np.fill_diagonal(linked, False)
        cls, n, whole = left.cls.to_numpy(), linked @ left.rows.to_numpy(), linked
    else:
        cls = np.concatenate([left.cls, right.cls])
        n = np.concatenate([linked @ right.rows.to_numpy(), linked.T @ left.rows.to_numpy()])
        whole = np.zeros((len(cls), len(cls)), bool)
        whole[: len(left), len(left) :] = linked
        whole |= whole.T
    some = np.flatnonzero(whole.any(axis=0))
    root = groups(whole[np.ix_(some, some)])
    return pd.DataFrame({"cls": cls[some], "n": n[some], "root": cls[some][root]})


def _classes(rows: DataFrame) -> DataFrame:
    """(cls, label, v, id, rows): the vectors of each label, equal ones once, with the smallest id and the number of rows."""
    found = rows.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("rows"))
    return written(found.select(F.monotonically_increasing_id().alias("cls"), "*"), "cosine-classes")


def _middles(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centres for each length of vectors that the sample holds, in proportion to its share of it."""
    sample = classes.select("v", F.xxhash64("v").alias("h")).distinct().orderBy("h", "v").limit(SAMPLE).collect()
    if not sample:
        return {}
    by = defaultdict(list)
    for r in sample:
        by[len(r.v)].append(r.v)
    total = classes.count()
    # At most CENTRES vectors for a length, and never more than the sample.
    return {
        n: centres(_unit(stacked(own)), min(CENTRES, len(own), max(1, -(-total * len(own) // len(sample) // PER_CELL))))
        for n, own in by.items()
    }


def _links(classes: DataFrame, least: float) -> DataFrame:
    """(cls, n, root) of every block; see ``compared``. Vectors meet others of their length only."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(_middles(classes))
    label = classes.schema["label"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for length, own in df.groupby(df.v.map(len)):
                middle = shared.value.get(length)  # a length that the sample does not hold has one cell
                into = np.ones((len(own), 1), bool) if middle is None else cells(_unit(stacked(own.v)), middle, least)
                yield own.assign(length=np.int32(length), cells=[np.flatnonzero(m).astype(np.int32) for m in into])

    placed = classes.select("cls", "label", "rows", "v").mapInPandas(
        place, f"cls long, label {label}, rows long, v array<double>, length int, cells array<int>"
    )
    placed = written(placed, "cosine-placed").withColumn("cell", F.explode("cells"))
    blocks = placed.groupBy("label", "length", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # A block meets itself and every other block of its cell; the rows of a large cell are spread over its blocks.
    sides = (
        placed.join(blocks, ["label", "length", "cell"])
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "length", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "rows", "v", "cells")
    )

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        *_, cell, i, j = key
        df = df.sort_values("cls")
        left, right = df[df.own == i], None if i == j else df[df.own == j]
        if len(df) < 2 or not len(left) or right is not None and not len(right):
            return pd.DataFrame({"cls": [], "n": [], "root": []}, dtype="int64")
        return compared(int(cell), left, right, least)

    return written(sides.groupBy("label", "length", "cell", "i", "j").applyInPandas(run, "cls long, n long, root long"), "cosine-links")


def near_duplicates(df: DataFrame, least: float = LEAST) -> DataFrame:
    """One row for each row of ``df`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    * Links join rows of one label, of any type, whose vectors have one length and a cosine of ``least`` or more, in double precision. Rows with a null
      label, or a vector that ``usable`` leaves out, link with nothing: n_links 0, component_id their own id.
    * n_links counts all other rows linked directly, equal vectors included. component_id is the smallest id reachable; a null id
      is never the smallest, and a component of null ids alone has a null one. kept is vec_id = component_id, nulls included.
    * Repeated ids are rows of their own. Other columns are ignored. An empty table gives an empty result.
    """
    base = written(df.select("vec_id", "label", "embedding").withColumn("row", F.monotonically_increasing_id()), "cosine-rows")
    fit = usable(base.where(F.col("label").isNotNull())).select("row", "vec_id", "label", "v")
    classes = _classes(fit)
    found = _links(classes, least)
    reached = components(found.where("cls != root").select(F.col("cls").alias("a"), F.col("root").alias("b")), "cosine-groups")
    near = found.groupBy("cls").agg(F.sum("n").alias("n"))
    named = classes.join(near, "cls", "left").join(reached.withColumnRenamed("node", "cls"), "cls", "left").select(
        "label", "v", "id", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("component", "cls").alias("comp")
    )
    smallest = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    linked = named.join(smallest, "comp").select("label", "v", "n_links", "component_id")
    joined = fit.join(linked, ["label", "v"]).select("row", "vec_id", "n_links", "component_id")
    alone = base.join(fit.select("row"), "row", "left_anti").select("row", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_copies(df: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``df`` whose id is the representative of its component, with all their columns."""
    keep = near_duplicates(df, least).where("kept").select(F.col("vec_id").alias("id")).distinct()
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    return rows.join(keep, F.col("row.vec_id").eqNullSafe(F.col("id")), "left_semi").select("row.*")
