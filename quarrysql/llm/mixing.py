"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates between 0 and MOST that take a
source's target of words, the mix takes those nearest to 1 in relative entropy: exp(m * x), held at MOST, where
x is the document's size over its source's mean size and m the source's multiplier. The multipliers solve the
convex dual by Newton steps; a step sums gradient and curvature over all documents in Spark, and only the sums of
each source reach the driver. Rates are then rounded to whole copies.

Sources are a dimension: their names, sizes and multipliers are held on the driver, documents never are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.llm.common import WORD, local, text_of
from quarrysql.session import written

#: Most copies of a document, and most of a source's size that a target can be.
MOST = 3
#: Newton ends when every source is this near to its target, relatively. After so many steps the bounds alone are halved; so many
#: steps in all, and a source that is not there yet is an error.
NEAR, STEPS, ALL_STEPS = 1e-9, 40, 120
#: Rounding: bits of a document's rank that are narrowed down in each of two passes, and passes that fill what is left.
NARROW, FILLS = 12, 12


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3)) -> dict[str | None, float]:
    """Words to take of each source.

    Sources by code point, null last, weigh ``weights``, repeating. They share all words by weight; what is above
    MOST times a source's size is shared again by weight among the others, until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        share = left / sum(weigh[s] for s in open_)
        full = [s for s in names if s in open_ and share * weigh[s] >= MOST * sizes[s]]
        for s in full or list(open_):
            out[s] = float(MOST * sizes[s]) if full else share * weigh[s]
            open_.discard(s)
            left -= out[s]
    return out


@dataclass
class Part:
    """What the driver holds of a source: number, name, rows, size in words, target, multiplier, cut of the rounding."""

    no: int
    name: str | None
    rows: int
    size: int
    target: float
    m: float = 0.0
    low: float = -math.inf
    high: float = math.inf
    cut: int = 0

    @property
    def mean(self) -> float:
        return max(self.size, 1) / max(self.rows, 1)


def _sources(spark, parts: list[Part]) -> DataFrame:
    """One row a source. Small, and Spark knows its size, so it is broadcast when it may be."""
    rows = [(p.no, p.name, float(p.size), p.target, p.mean, p.m, p.cut, p.target >= MOST * p.size) for p in parts]
    return local(spark, rows, "no int, name string, source_size double, target double, mean double, m double, cut int, full boolean")


def _rate() -> Column:
    """A document's rate; full sources are taken MOST times, empty documents as they are."""
    x = F.col("m") * F.col("size") / F.col("mean")
    return F.when(F.col("full"), F.lit(float(MOST))).otherwise(F.least(F.lit(float(MOST)), F.exp(F.least(x, F.lit(5.0)))))


def _solve(hist: DataFrame, parts: list[Part]) -> None:
    """Newton steps on every multiplier at once, held between the bounds that the gradients' signs have set.

    Sums are of decimals, so they do not depend on the order in which rows arrive, and reruns agree.
    """
    spark = hist.sparkSession
    rate, x = _rate(), F.col("size") / F.col("mean")
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    for step_no in range(ALL_STEPS):
        live = [p for p in parts if 0 < p.target < MOST * p.size]
        sums = (
            hist.join(_sources(spark, live).select("no", "mean", "m", "full"), "no")
            .withColumn("r", rate)
            .groupBy("no")
            .agg(
                exact(F.col("rows") * F.col("size") * F.col("r")).alias("taken"),
                exact(F.when(F.col("r") < MOST, F.col("rows") * F.col("size") * F.col("r") * x)).alias("slope"),
            )
            .collect()
            if live
            else []
        )
        far = 0.0
        by = {p.no: p for p in live}
        for s in sums:
            p = by[s.no]
            gap = p.target - s.taken
            far = max(far, abs(gap) / p.target)
            p.low, p.high = (max(p.low, p.m), p.high) if gap > 0 else (p.low, min(p.high, p.m))
            step = p.m + (gap / s.slope if s.slope else math.copysign(1.0, gap))
            if math.isfinite(p.low) and math.isfinite(p.high):
                p.m = step if p.low < step < p.high and step_no < STEPS else (p.low + p.high) / 2
            else:
                p.m = min(max(step, p.m - 4.0), p.m + 4.0)
        if far <= NEAR or all(p.high - p.low <= 1e-15 * abs(p.m) for p in live):  # no number between the bounds comes nearer
            return
    raise RuntimeError(f"the rates of a source did not come within {NEAR} of its target in {ALL_STEPS} steps")


def _rank() -> Column:
    """A document's rank for the extra copy: its hash, in (0, 1), over the broken part of its rate, as 24 bits.

    Ranks of one half of 2**24 are hash over broken part = 1: taking all below it gives each document its extra
    copy with the probability of the broken part. The cut found by ``_round`` moves from there to the target.
    """
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "source", "size"), 12).cast("double") + 0.5) / float(1 << 52)
    v = u / (F.col("r") - F.floor("r"))
    return F.when(F.col("r") > F.floor("r"), F.floor(v / (1 + v) * (1 << 2 * NARROW)).cast("int"))


def _round(units: DataFrame, parts: list[Part]) -> None:
    """Finds each source's cut: documents of rank below it take one copy more, for as near to the target as may be."""
    spark = units.sparkSession
    ranked = units.join(_sources(spark, parts).drop("target", "source_size", "cut"), "no").withColumn("r", _rate()).withColumn("rank", _rank())
    words = F.col("rows") * F.col("size")
    whole = {r.no: r.w for r in ranked.groupBy("no").agg(F.sum(words * F.floor("r")).alias("w")).collect()}
    left = {p.no: p.target - (whole.get(p.no) or 0) for p in parts}
    high = (ranked.where("rank IS NOT NULL AND size > 0").groupBy("no", F.shiftright("rank", NARROW).alias("b")).agg(F.sum(words).alias("w")))
    found = _narrowed(high, left)
    edges = local(spark, [(no, b) for no, (b, _) in found.items()], "no int, edge int")
    low = (
        ranked.where("rank IS NOT NULL AND size > 0").join(edges, "no").where(F.shiftright("rank", NARROW) == F.col("edge"))
        .groupBy("no", (F.col("rank") % (1 << NARROW)).alias("b")).agg(F.sum(words).alias("w"))
    )
    inner = _narrowed(low, {no: rest for no, (_, rest) in found.items()})
    for p in parts:
        b, _ = found.get(p.no, (0, 0.0))
        c, _ = inner.get(p.no, (0, 0.0))
        p.cut = (b << NARROW) + c


def _narrowed(sums: DataFrame, left: dict[int, float]) -> dict[int, tuple[int, float]]:
    """For each source the first of at most 2**NARROW buckets that does not fit what is left, and what is left there."""
    goal = local(sums.sparkSession, list(left.items()), "no int, goal double")
    w = Window.partitionBy("no").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumn("upto", F.sum("w").over(w)).join(goal, "no")
    rows = run.groupBy("no").agg(
        F.min(F.when(F.col("upto") > F.col("goal"), F.struct("b", F.col("upto") - F.col("w")))).alias("stop"),
        F.max("b").alias("last"),
        F.max("upto").alias("all"),
    )
    return {
        r.no: (r.stop[0], left[r.no] - r.stop[1]) if r.stop else (r["last"] + 1, left[r.no] - r["all"]) for r in rows.collect()
    }


def _copies() -> Column:
    extra = F.when(F.col("rank").isNotNull() & (F.col("rank") < F.col("cut")), 1).otherwise(0)
    return (F.floor("r") + extra).cast("int")


@dataclass
class Mix:
    """A fitted mix: the sources with their multipliers and cuts, and the documents that take one copy more."""

    parts: list[Part]
    picks: list[tuple]
    units: DataFrame


def _sized(docs: DataFrame) -> Column:
    return F.regexp_count(text_of(), F.lit(WORD)).cast("long")


def fit(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> Mix:
    """Solves for the rates and the rounding of all rows of ``docs``.

    What rounding leaves of a target is filled by single documents, each the largest that still fits, smallest
    id first, one for each source and pass. Rows equal in id, source and size count as one unit throughout.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", "source", _sized(docs).alias("size"))
    units = written(base.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    sums = units.groupBy("source").agg(F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("size")).alias("w")).collect()
    sizes = {r.source: (r.n, int(r.w)) for r in sums}
    goal = targets({s: w for s, (_, w) in sizes.items()}, weights)
    parts = [Part(i, s, *sizes[s], goal[s]) for i, s in enumerate(goal)]
    numbered = units.join(_sources(spark, parts).select("no", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    hist = written(numbered.where("size > 0").groupBy("no", "size").agg(F.sum("rows").alias("rows")), "mix-sizes")
    _solve(hist, parts)
    _round(numbered, parts)

    rated = written(_applied(units, Mix(parts, [], units)), "mix-rated")
    words = F.col("rows") * F.col("size")
    taken = {r.no: r.w for r in rated.groupBy("no").agg(F.sum(words * F.col("copies")).alias("w")).collect()}
    left = {p.no: p.target - taken.get(p.no, 0) for p in parts}
    picks: list[tuple] = []
    for _ in range(FILLS):
        gaps = local(spark, [(no, float(x)) for no, x in left.items() if x >= 1], "no int, gap double")
        fits = rated.where(f"copies < {MOST} AND size > 0").join(gaps, "no").where(words <= F.col("gap"))
        before = local(spark, picks, "p_no int, p_id long, p_size long")
        fits = fits.join(before, (F.col("no") == F.col("p_no")) & F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("size") == F.col("p_size")), "left_anti")
        best = fits.groupBy("no").agg(F.max(F.struct(words.alias("w"), (-F.col("doc_id")).alias("minus"), "size")).alias("best")).collect()
        if not best:
            break
        for r in best:
            picks.append((r.no, None if r.best.minus is None else -r.best.minus, r.best["size"]))
            left[r.no] -= r.best.w
    return Mix(parts, picks, units)


def _applied(rows: DataFrame, mix: Mix) -> DataFrame:
    """Adds no, source_size, target, rate and copies to rows that have doc_id, source and size.

    A number of copies follows from the row and its source alone, so no row is exchanged.
    """
    spark = rows.sparkSession
    picks = local(spark, mix.picks, "p_no int, p_id long, p_size long")
    rated = rows.join(_sources(spark, mix.parts), F.col("source").eqNullSafe(F.col("name"))).withColumn("r", _rate()).withColumn("rank", _rank())
    picked = rated.join(picks, (F.col("no") == F.col("p_no")) & F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("size") == F.col("p_size")), "left")
    return picked.select(
        *rows.columns, "no", F.col("source_size").cast("long").alias("source_size"), "target", F.col("r").alias("rate"),
        (_copies() + F.when(F.col("p_no").isNotNull(), 1).otherwise(0)).alias("copies"),
    )


def _each(df: DataFrame, count: Column) -> DataFrame:
    """Each row as often as ``count`` says."""
    return df.withColumn("one", F.explode(F.array_repeat(F.lit(True), count.cast("int")))).drop("one")


def report(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken (size times copies), rate and copies.

    Size is the number of words, 0 for a null text. A null source is a source of its own. A document without
    words adds none; it has the copies of its rate, 1 unless its source is full. Null and repeated ids are
    documents like others. Other columns are ignored. An empty table gives an empty result.
    """
    mix = fit(docs)
    found = _each(_applied(mix.units, mix), F.col("rows"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns; rows not taken are gone.

    Nulls, empty texts and repeated rows count as ``report`` says; an empty table gives an empty one. Columns of any
    name are kept, those that the mix adds stay out.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", _sized(docs).alias("size"))
    found = _applied(rows, fit(docs)).where("copies > 0")
    return _each(found.select("row", "copies"), F.col("copies")).select("row.*")
