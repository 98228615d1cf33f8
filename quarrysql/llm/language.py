"""Language identification in two steps: the family of a language first, then the language within its family.

Texts become counts of byte runs of two to four in their lower-cased letters, hashed to slots. At either step linear support vector machines
decide between each two classes; the class that wins most of its contests is taken. A language is only ever held
against those of its own family, so close relatives have machines of their own that look at nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysql.llm.common import is_fold, local, small_batches, text_of

#: Training documents read at most, each whole, dealt evenly to the languages; and languages learnt at most, the most frequent ones.
SAMPLE, LANGUAGES = 3_000, 200
#: Slots of byte runs, in bits; one more slot is the constant. A document has at most that many values, whatever its length.
BITS = 14
#: Value of the constant, cost of an error, passes over the sample.
CONSTANT, COST, PASSES = 0.2, 10.0, 20
#: Bytes of a text that are counted at a time.
SLICE = 1 << 20
#: What a text without letters, or without any model, is called.
UNKNOWN = "und"

# Families by language code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "semitic": ("ar", "he", "mt"),
    "malayic": ("id", "jv", "ms"),
}
_FAMILY = {language: family for family, own in FAMILIES.items() for language in own}
# Odd multipliers that spread runs of two, three and four bytes over the slots.
_SPREAD = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def family(language: str) -> str:
    """The family of a language code; what follows the first two or three letters, as in en-GB, does not count."""
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], language)


def letters(text: Column) -> Column:
    """The lower-cased letters of a text, one blank for each run of other characters, as bytes."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")).cast("binary")


def features(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a line of letters: roots of the shares of its byte runs, of length 1, and the constant."""
    counts = np.zeros(1 << BITS)
    line = b" " + line + b" "
    for at in range(0, len(line), SLICE):
        x = np.frombuffer(line[at : at + SLICE + 3], np.uint8).astype(np.uint32)
        # the runs that begin in this slice; those of the last three bytes are cut at the end of the line
        ahead, run = min(SLICE, len(x)), x
        for k, spread in enumerate(_SPREAD, 1):
            run = (run[:-1] << np.uint32(8)) | x[k:]
            counts += np.bincount((run[:ahead] * np.uint32(spread)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    slots = np.flatnonzero(counts)
    values = np.sqrt(counts[slots] / max(1.0, counts.sum()))
    return np.append(slots, 1 << BITS), np.append(values, CONSTANT)


Sample = list[tuple[np.ndarray, np.ndarray]]


def machine(rows: Sample, signs: np.ndarray, cost: float = COST, passes: int = PASSES) -> np.ndarray:
    """Weights of a linear support vector machine, by coordinate descent on its dual, in an order that repeats."""
    weights, share = np.zeros((1 << BITS) + 1), np.zeros(len(rows))
    norms = [float(v @ v) for _, v in rows]
    order = np.random.default_rng(12)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slots, values = rows[i]
            gradient = signs[i] * (weights[slots] @ values) - 1
            new = min(max(share[i] - gradient / norms[i], 0.0), cost)
            if new != share[i]:
                weights[slots] += (new - share[i]) * signs[i] * values
                moved, share[i] = max(moved, abs(new - share[i])), new
        if moved < 1e-3 * cost:
            break
    return weights


@dataclass
class Contest:
    """Machines between each two of ``classes``; a positive margin speaks for the first of a pair."""

    classes: list[str]
    weights: np.ndarray  # slots x pairs

    def winner(self, slots: np.ndarray, values: np.ndarray) -> tuple[str, float]:
        """The class with most wins, ties by margins, and how sure its closest contest is: 1 without any other class."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margins = values @ self.weights[slots]
        wins, sums, closest = (np.full(len(self.classes), x) for x in (0.0, 0.0, np.inf))
        for (a, b), m in zip(combinations(range(len(self.classes)), 2), margins):
            for c, own in ((a, m), (b, -m)):
                wins[c] += own > 0
                sums[c] += own
                closest[c] = min(closest[c], own)
        best = max(range(len(self.classes)), key=lambda c: (wins[c], sums[c]))
        return self.classes[best], float(1 / (1 + np.exp(-2 * np.clip(closest[best], -20, 20))))


def contest(rows: Sample, names: list[str]) -> Contest:
    classes = sorted(set(names))
    own = {c: [r for r, n in zip(rows, names) if n == c] for c in classes}
    found = [
        machine(own[a] + own[b], np.array([1.0] * len(own[a]) + [-1.0] * len(own[b]))).astype(np.float32) for a, b in combinations(classes, 2)
    ]
    return Contest(classes, np.stack(found, axis=1) if found else np.empty((0, 0), np.float32))


@dataclass
class Model:
    families: Contest | None
    languages: dict[str, Contest]

    def predict(self, line: bytes) -> tuple[str, float]:
        """A learnt language and a score of 0 to 1; ``UNKNOWN`` and 0 for a line without letters, or if nothing was learnt."""
        if not line or self.families is None:
            return UNKNOWN, 0.0
        row = features(line)
        group, sure = self.families.winner(*row)
        language, surer = self.languages[group].winner(*row)
        return language, sure * surer


def fitted(rows: Sample, names: list[str]) -> Model:
    """The machines for families, and for each family those for its languages."""
    if not rows:
        return Model(None, {})
    groups = [family(n) for n in names]
    own = {g: [k for k, other in enumerate(groups) if other == g] for g in set(groups)}
    return Model(contest(rows, groups), {g: contest([rows[k] for k in at], [names[k] for k in at]) for g, at in own.items()})


def train(docs: DataFrame, lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learns from at most ``sample`` rows of ``docs`` (doc_id, text, and ``lang``), the same ones on each run.

    Rows with a null language or a text without letters teach nothing. One count for each language tells what share of its rows to
    read; the share is taken by a hash of id and text. Only slots and values of the sample reach the driver, at most
    6 * 2 ** BITS bytes a document however long its text. An empty table gives a model that knows no language.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.select("doc_id", "text", F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return Model(None, {})
    shares = local(spark, [(r.lang, min(1.0, sample / len(sizes) / r.n)) for r in sizes], "lang string, share double")
    place = F.xxhash64("doc_id", "text")

    @F.arrow_udf("struct<slots: binary, values: binary>")
    def hashed(lines: pa.Array) -> pa.Array:
        found = [features(x) for x in lines.to_pylist()]
        columns = [pa.array([a.astype(kind).tobytes() for a in c], pa.binary()) for c, kind in zip(zip(*found), (np.uint16, np.float32))]
        return pa.StructArray.from_arrays(columns or [pa.array([], pa.binary())] * 2, names=["slots", "values"])

    rows = (
        known.join(F.broadcast(shares), "lang")
        .select("lang", place.alias("place"), "share", "text")
        .where(F.shiftrightunsigned("place", 11) < F.col("share") * float(1 << 53))
        .select("lang", "place", letters(F.col("text")).alias("line"))
        .where(F.length("line") > 0)
        .orderBy("place", "lang")
        .limit(sample)  # the shares add up to about this; copies of one row share a place
        .select("lang", "place", hashed("line").alias("f"))
        .collect()
    )
    rows.sort(key=lambda r: (r.place, r.lang))
    read = [(np.frombuffer(r.f.slots, np.uint16).astype(np.int64), np.frombuffer(r.f["values"], np.float32).astype(np.float64)) for r in rows]
    return fitted(read, [r.lang for r in rows])


def predicted(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """A struct (lang, score) for each whole text, see ``Model.predict``. The model goes to each worker once."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    fields = [pa.field("lang", pa.string()), pa.field("score", pa.float64())]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for lines in batches:
            columns = list(zip(*map(model.predict, lines.to_pylist()))) or [(), ()]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<lang: string, score: double>")(letters(text_of(text)))


def report(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """The language of each row: doc_id, held_out, lang_pred, score.

    Learns from rows whose crc32(doc_id as text) mod ``parts`` is not ``held``; a null id is never held out. Null and empty texts, and texts
    without letters, are ``und`` with score 0. Repeated rows have equal results. Other columns are ignored.
    """
    held_out = is_fold("doc_id", parts, held)
    model = train(docs.select("doc_id", "text", "lang").where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), predicted(docs.sparkSession, model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")
