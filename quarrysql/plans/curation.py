"""The three end-to-end jobs: build a corpus, add code files to it, score model outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrysql.functions import chat, statements
from quarrysql.functions.scoring import keyword_coverage
from quarrysql.functions.text import as_col, compute_once
from quarrysql.operators import dedup, extract, sampling, score
from quarrysql.session import written


def length_filter(df: DataFrame, text: str = "text", low: int = 10, high: int = 2048) -> DataFrame:
    """Rows whose text length lies in the range, ends included."""
    return df.where(F.length(text).between(low, high))


def english_only(df: DataFrame, language: str | None = None, text: str = "text") -> DataFrame:
    """By a language column where there is one, else by stop-words."""
    return df.where(as_col(language) == "en") if language else df.where(statements.looks_english(text))


def stage(
    common: DataFrame, dialect: str = "postgres", lint: bool = True, compat: bool = False, reasoning: bool = True
) -> DataFrame:
    """Common rows with gated SQL, the reason of a refusal, and the finished transcript. One narrow pass."""
    judged = statements.gate(
        compute_once(common, sql=statements.gated_sql("sql", dialect)), lint=lint, compat=compat
    )
    include = chat.reasoning_mix("row_id") if reasoning else F.lit(False)
    text = chat.render_chat(
        statements.canonicalize_schema("schema_ddl"), "question", "sql", dialect, include  # sql is trimmed already
    )
    kind = statements.sql_type(statements.strip_reasoning("sql"))
    return judged.withColumn("text", text).withColumn("sql_type", kind)


def rebuild_text(
    df: DataFrame, dialect: str = "sql", lint: bool = True, compat: bool = False, text: str = "text"
) -> DataFrame:
    """Transcripts of either dialect in the tagged one, with ``question``, ``sql`` and ``reject_reason``.

    Rows without an answer pass as they are. Refused rows get an empty text. ``compat=True`` keeps a
    think block that the answer already has.
    """
    answer = chat.assistant_sql(text) if compat else statements.strip_reasoning(chat.assistant_sql(text))
    judged = statements.gate(
        compute_once(df, sql=statements.gated_sql(answer, dialect)), "sql", "_reason", lint, compat
    )
    has_sql = F.col("sql") != ""
    judged = judged.withColumn("reject_reason", F.when(has_sql, F.col("_reason"))).drop("_reason")
    usable = has_sql & F.col("reject_reason").isNull()
    asked = F.when(usable, chat.rebuilt_question(text)).otherwise(chat.user_question(text))
    judged = compute_once(judged, question=asked)
    body = chat.with_reasoning("sql", chat.reasoning_mix("row_id"))
    rebuilt = chat.render_turns(chat.system_content(text, dialect), "question", body)
    return judged.withColumn(
        text, F.when(~has_sql, F.col(text)).when(usable, rebuilt).otherwise(F.lit(""))
    )


def passed(staged: DataFrame, low: int = 10, high: int = 2048) -> DataFrame:
    """Rows that passed the gate and the length limits."""
    good = compute_once(staged.where(F.col("reject_reason").isNull()), text=F.col("text"))
    return length_filter(good, "text", low, high)


def accepted(staged: DataFrame, low: int = 10, high: int = 2048) -> DataFrame:
    """Passed rows, one per question."""
    return dedup.dedup_first(passed(staged, low, high), "question")


def curate(
    common: DataFrame, dialect: str = "postgres", ratio: float = 0.77, lint: bool = True, write_between: bool = True
) -> DataFrame:
    """Common rows to a balanced corpus: stage, gate, length, dedup, rebalance.

    Rebalancing reads the deduplicated rows three times, twice for two narrow columns. So they are
    written once to the shared folder, in a columnar form; ``write_between=False`` keeps one lazy plan.
    """
    columns = ["row_id", "source", "source_rank", "question", "sql", "sql_type", "text"]
    unique = accepted(stage(common, dialect, lint)).select(*columns)
    return sampling.rebalance(written(unique, "unique") if write_between else unique, ratio)


def accepted_statements(found: DataFrame) -> DataFrame:
    """Extracted statements, each whole text once, that pass the gate. Refused rows count as seen."""
    unique = dedup.dedup_first(found, F.sha2("sql", 256), order=("path", "stmt_no"))
    return statements.gate(unique).where("reject_reason IS NULL AND instruction <> ''").drop("reject_reason")


def code_transcripts(files: DataFrame, dialect: str = "sql") -> DataFrame:
    """Code files to legacy transcripts: select, extract, dedup, gate, format."""
    good = accepted_statements(extract.extract_statements(extract.select_sql_files(files)))
    return good.select(
        "path", "stmt_no", chat.render_legacy("schema_ddl", "instruction", "sql", dialect).alias("text")
    )


def merge_code(current: DataFrame, transcripts: DataFrame, order: str, cap: int | None = None) -> DataFrame:
    """New transcripts that repeat neither a kept statement nor a known question, appended.

    ``order`` is a unique sortable id of the transcripts, a number or a struct; ``cap``, where given, limits the transcripts.
    The candidates are written once: the rounds read their keys, the result their text.
    """
    limited = transcripts if cap is None else sampling.cap_source(transcripts, cap, order)
    candidates = written(dedup.merge_candidates(limited), "candidates")
    known = dedup.question_keys(current.select("text")).where("question_key <> ''").select("question_key")
    kept = dedup.dedup_greedy(candidates, "sql_key", "question_key", order, existing=known)
    return dedup.append_source(current, kept)


def evaluate(outputs: DataFrame, models: list[str], rule: str = "checkpoints") -> DataFrame:
    """Raw model outputs to the leaderboard."""
    return score.leaderboard(score.evaluated(outputs, rule), models)


def coverage_scores(outputs: DataFrame, required) -> DataFrame:
    """A65 per row: the share of required words in the cleaned output."""
    cleaned = score.evaluated(outputs)
    return cleaned.withColumn("score", keyword_coverage("sql", required))
