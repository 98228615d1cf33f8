"""Checks on a finished corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrysql.functions.chat import DIRECT_VERBS, TAGGED_MARK
from quarrysql.functions.text import starts_with_any, strip

# Markers of either SQL dialect, matched as substrings.
MYSQL_MARKS = ("YEAR(", "MONTH(", "DAY(", "DATE_SUB", "STR_TO_DATE")
POSTGRES_MARKS = ("EXTRACT(YEAR", "EXTRACT(MONTH", "EXTRACT(DAY", "INTERVAL", "TO_DATE")

# Opening tags per chat dialect, and the closing tag.
CHAT_TAGS = {
    "legacy": {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>", "end": "<|end|>"},
    "tagged": {
        "system": "<|im_start|>system",
        "user": "<|im_start|>user",
        "assistant": "<|im_start|>assistant",
        "end": "<|im_end|>",
    },
}

FIELDS = ("text", "context", "question", "answer")


def row_checks(df: DataFrame, dialect: str = "legacy", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Adds ``issues``, the names of failed checks; a row with missing fields reports only that."""
    tags = CHAT_TAGS[dialect]
    text = F.col("text")
    missing = F.lit(False)
    for name in fields:
        missing = missing | F.col(name).isNull()
    ends = F.length(text) - F.length(F.replace(text, F.lit(tags["end"]), F.lit("")))
    tests: dict[str, Column] = {
        "no_system": ~text.contains(tags["system"]),
        "no_schema": ~text.contains("Schema:"),
        "no_user": ~text.contains(tags["user"]),
        "no_assistant": ~text.contains(tags["assistant"]),
        "few_end_tags": ends < 3 * len(tags["end"]),
        "empty_sql": strip("answer") == "",
        "empty_question": strip("question") == "",
        "too_short": F.length(text) < 50,
        "too_long": F.length(text) > 2048,
    }
    found = F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))
    return df.withColumn("issues", F.when(missing, F.array(F.lit("missing_fields"))).otherwise(found))


def issue_report(checked: DataFrame) -> DataFrame:
    """Rows per issue, or the single line ``all valid``."""
    # explode_outer keeps the rows without issues under one name, so one aggregation tells both.
    counted = (
        checked.select(F.explode_outer("issues").alias("issue"))
        .groupBy("issue")
        .agg(F.count("*").alias("n"))
        .agg(F.collect_list(F.struct("issue", "n")).alias("found"))  # ten names at most
    )
    faults = F.filter("found", lambda f: f["issue"].isNotNull())
    clean = F.array(F.struct(F.lit("all valid").alias("issue"), F.lit(0).cast("bigint").alias("n")))
    return counted.select(F.inline(F.when(F.size(faults) > 0, faults).otherwise(clean)))


def readiness(df: DataFrame, text: str = "text") -> DataFrame:
    """Shares of tagged, reasoning and direct rows, and whether the corpus is ready.

    Looks at all rows; pass the first thousand for the quick form. Empty input gives nulls.
    """
    t = F.col(text)
    pattern = r"(?s)<\|im_start\|>assistant\n(.*?)<\|im_end\|>"
    answer = strip(F.regexp_extract(t, pattern, 1))
    thinks = answer.contains("<think>")
    direct = ~thinks & starts_with_any(answer, DIRECT_VERBS)
    rates = df.agg(
        F.count("*").alias("n"),
        F.avg(t.contains(TAGGED_MARK).cast("double")).alias("tagged_rate"),
        F.avg(thinks.cast("double")).alias("reasoning_rate"),
        F.avg(direct.cast("double")).alias("direct_rate"),
    )
    share = F.col("reasoning_rate")
    mix = F.when(share.between(0.70, 0.80), "ok").when(share < 0.70, "too few").when(share > 0.80, "too many")
    return rates.withColumn("reasoning_label", mix).withColumn(
        "ready", (F.col("tagged_rate") >= 0.95) & share.between(0.70, 0.80)
    )


def dialect_residue(df: DataFrame, sql: str = "sql") -> DataFrame:
    """Rows that hold each marker; markers of the old dialect should be gone."""
    s = F.upper(F.col(sql))
    marks = [("mysql", m) for m in MYSQL_MARKS] + [("postgres", m) for m in POSTGRES_MARKS]
    sums = [
        F.coalesce(F.sum(s.contains(m).cast("bigint")), F.lit(0)).alias(f"c{i}") for i, (_, m) in enumerate(marks)
    ]
    wide = df.agg(*sums)
    rows = [
        F.struct(F.lit(d).alias("dialect"), F.lit(m).alias("marker"), F.col(f"c{i}").alias("n"))
        for i, (d, m) in enumerate(marks)
    ]
    status = (
        F.when(F.col("dialect") == "mysql", F.when(F.col("n") == 0, "ok").otherwise("problem"))
        .when(F.col("n") > 0, "ok")
        .otherwise("info")
    )
    return wide.select(F.inline(F.array(*rows))).withColumn("status", status)


def residue_verdict(residue: DataFrame) -> DataFrame:
    """Hits of the old dialect in all, and the verdict."""
    hits = F.sum(F.when(F.col("dialect") == "mysql", F.col("n")).otherwise(0))
    return residue.agg(hits.alias("mysql_hits")).withColumn(
        "verdict", F.when(F.col("mysql_hits") == 0, "clean").otherwise("residue")
    )


def sample_rows(df: DataFrame, predicate: Column, n: int = 5, order: str = "row_id") -> DataFrame:
    """The first ``n`` rows that match."""
    return df.where(predicate).orderBy(order).limit(n)


def rows_at(df: DataFrame, ids: list[int], order: str = "row_id") -> DataFrame:
    """The rows at fixed positions; positions past the end are left out."""
    return df.where(F.col(order).isin(*ids)).orderBy(order)
