"""Secret scans with column functions alone: three patterns, and Shannon entropy in a sliding window.

A candidate is a run of ``CANDIDATE`` characters of 20 or more. A window of 20 characters slides over it. The
counts of the characters in the window, and the sum of n * log2(n) over them, are carried from place to place:
one character enters, one leaves. The entropy of a window is log2(20) minus that sum / 20. Windows at or above
the limit of the candidate's character class are joined where they touch and become spans of kind ``entropy``.

Sums are kept in whole units of 2**-20, so that any engine finds the same windows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.llm.common import text_of

# The patterns and least lengths of the three base kinds, in the order of the result.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # 16 characters in all
HEX = r"[0-9a-f]{32,}"
#: Texts without any of these, in lower case, hold no match of a kind; looking for them is cheaper than the pattern.
NEEDS = {ASSIGN: ["passw", "secret", "token", "api"], ACCESS: ["akia"]}
KINDS = ["assign", "access", "hex", "entropy"]

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Least bits a character, by class: hexadecimal digits alone, or any of the alphabet.
BITS = {"hex": 3.0, "any": 3.9}
#: What is never a secret. Patterns that begin with ^ look at a whole candidate: words and plain numbers, numbered UUIDs, digests that say
#: what they are. Others look at a joined span of windows alone, whatever stands beside it: sequences and fillers, and paths of words.
ALLOWED = [
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(1|256|384|512)-",
    r"(?i)(0123456789|abcdefghij|example|placeholder|xxxxxx|/[a-z]+/[a-z]+/)",
]
UNIT = 1 << 20
#: Place sums are taken in blocks of this many matches, so that a text full of matches stays cheap.
STEP = 256


def weight(n: int) -> int:
    """n * log2(n) in units of 2**-20."""
    return round(n * math.log2(n) * UNIT) if n else 0


def limit(bits: float) -> int:
    """The largest sum of weights that a window of at least ``bits`` can have."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * UNIT)


def _ends(steps: Column) -> Column:
    """Running sums of an array of lengths, by blocks."""
    block = lambda b: F.slice(steps, b * STEP + 1, F.lit(STEP))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / STEP).cast("int"))
    before = F.aggregate(
        F.transform(blocks, lambda b: total(block(b))),
        F.array(F.lit(0)),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
    )
    return F.flatten(
        F.transform(blocks, lambda b: F.transform(block(b), lambda _, i: F.get(before, b) + total(F.slice(steps, b * STEP + 1, i + 1))))
    )


def _found(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: an array of (s, e, v), the places and text of the leftmost matches, ends exclusive, in characters."""
    text, empty = F.col("t"), F.lit(None).cast("array<struct<s:int,e:int,v:string>>")
    some = text.rlike(pattern)
    if pattern in NEEDS:
        some = reduce(or_, [F.col("low").contains(x) for x in NEEDS[pattern]]) & some
    df = df.withColumn("_v", F.when(some, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))))
    df = df.withColumn("_gap", F.when(F.size("_v") > 0, F.split("t", pattern, -1)))
    df = df.withColumn("_step", F.transform("_v", lambda v, i: F.length(v) + F.length(F.get("_gap", i))))
    df = df.withColumn("_e", F.when(F.size("_step") > 0, _ends(F.col("_step"))))
    spans = F.transform("_v", lambda v, i: F.struct((F.get("_e", i) - F.length(v)).alias("s"), F.get("_e", i).alias("e"), v.alias("v")))
    return df.withColumn(name, F.coalesce(F.when(F.size("_v") > 0, spans), F.coalesce(empty, F.array()))).drop("_v", "_gap", "_step", "_e")


def _windows(value: Column) -> Column:
    """Joined windows of high entropy in a candidate: an array of (s, e) within it."""
    codes = F.transform(F.filter(F.split(value, "(?<=.)"), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    weights = F.array(*[F.lit(weight(n)) for n in range(WINDOW + 2)])
    most = F.when(value.rlike("^[0-9a-fA-F]+$"), limit(BITS["hex"])).otherwise(limit(BITS["any"]))
    spans = "array<struct<s:int,e:int>>"
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"),
        F.lit(0).alias("sum"),
        F.lit(-1).alias("s"),
        F.lit(-1).alias("e"),
        F.array().cast(spans).alias("done"),
    )

    def slide(state: Column, i: Column, held: Column) -> Column:
        enters = F.get(held, i - 1)
        leaves = F.when(i > WINDOW, F.get(held, i - 1 - WINDOW)).otherwise(0)
        n = state["n"]
        had = F.get(n, enters - 1)
        stay = F.get(n, leaves - 1) + F.when(leaves == enters, 1).otherwise(0)
        total = (
            state["sum"] + F.get(weights, had + 1) - F.get(weights, had)
            + F.when(leaves > 0, F.get(weights, stay - 1) - F.get(weights, stay)).otherwise(0)
        )
        counts = F.transform(n, lambda v, j: v + F.when(j + 1 == enters, 1).otherwise(0) - F.when(j + 1 == leaves, 1).otherwise(0))
        hit = (i >= WINDOW) & (total <= most)
        joins = hit & (state["e"] >= i - WINDOW)
        opens = hit & ~joins
        return F.struct(
            counts.alias("n"),
            total.alias("sum"),
            F.when(opens, i - WINDOW).otherwise(state["s"]).alias("s"),
            F.when(hit, i).otherwise(state["e"]).alias("e"),
            F.when(opens & (state["e"] >= 0), F.concat(state["done"], F.array(F.struct(state["s"].alias("s"), state["e"].alias("e")))))
            .otherwise(state["done"]).alias("done"),
        )

    close = lambda x: F.when(x["e"] >= 0, F.concat(x["done"], F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))).otherwise(x["done"])
    # The codes are bound once, as the element of an array of one.
    return F.flatten(
        F.transform(
            F.array(codes),
            lambda held: F.aggregate(F.sequence(F.lit(1), F.size(held)), start, lambda state, i: slide(state, i, held), close),
        )
    )


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def scan(df: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Adds ``spans`` to a frame with the text in column ``t``: an array of (s, k, e) in order of start and kind.

    ``t`` must not be null. ``allowed`` are patterns besides ALLOWED that suppress a candidate of kind entropy (with ^) or a span of it.
    """
    df = df.withColumn("low", F.lower("t"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("runs", CANDIDATE)):
        df = _found(df, f"_{name}", pattern)
    stop = [*ALLOWED, *(allowed or [])]
    passes = lambda v, anchored: ~reduce(or_, [v.rlike(p) for p in stop if p.startswith("^") == anchored], F.lit(False))
    df = df.withColumn("_runs", F.filter("_runs", lambda x: passes(x["v"], True)))
    kept = lambda x: F.filter(_windows(x["v"]), lambda y: passes(F.substr(x["v"], y["s"] + 1, y["e"] - y["s"]), False))
    entropy = F.flatten(
        F.transform("_runs", lambda x: F.transform(kept(x), lambda y: F.struct((x["s"] + y["s"]).alias("s"), F.lit(3).alias("k"), (x["s"] + y["e"]).alias("e"))))
    )
    assign = F.filter("_assign", lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 2)) >= ASSIGN_LEAST)
    spans = F.concat(_of_kind(assign, 0), _of_kind(F.col("_access"), 1), _of_kind(F.col("_hex"), 2), F.when(F.size("_runs") > 0, entropy).otherwise(F.array().cast("array<struct<s:int,k:int,e:int>>")))
    return df.withColumn("spans", F.array_sort(spans)).drop("_assign", "_access", "_hex", "_runs", "low")


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kind, x["k"]), x["s"], x["e"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row for each row: counts of the base kinds, a digest of the base spans, and all spans.

    A null text is an empty one: no spans, and the digest of the empty list. Repeated rows and null ids are
    rows like others. Other columns are ignored, whatever their names.
    """
    df = scan(docs.select("doc_id", text_of().alias("t")))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["k"] == kind)).cast("long")
    return df.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` and ``n_chars`` counted anew where a span was found.

    Spans that overlap or touch are one. Rows without a span, null texts included, stay as they are. All
    columns are kept.
    """
    df = scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of().alias("t")))
    text = F.col("t")
    until = lambda a: F.greatest(a["at"], F.lit(0))
    step = lambda a, x: F.when(
        x["s"] > a["at"],
        F.struct(x["e"].alias("at"), F.concat(a["text"], text.substr(until(a) + 1, x["s"] - until(a)), F.lit(mark)).alias("text")),
    ).otherwise(F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["text"].alias("text")))
    first = F.struct(F.lit(-1).alias("at"), F.lit("").alias("text"))  # -1: a span may begin at 0
    clean = F.aggregate("spans", first, step, lambda a: F.concat(a["text"], text.substr(until(a) + 1, F.length(text))))
    df = df.withColumn("clean", F.when(F.size("spans") > 0, clean))
    out = []
    for c in docs.columns:
        column = F.col("row")[c]
        if c == "text":
            column = F.coalesce(F.col("clean"), column)
        elif c == "n_chars":
            column = F.when(F.col("clean").isNotNull(), F.length("clean").cast(docs.schema[c].dataType)).otherwise(column)
        out.append(column.alias(c))
    return df.select(*out)
