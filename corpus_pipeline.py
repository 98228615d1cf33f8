"""A training corpus from raw documents: five stages, each over all rows that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared folder and hands it
on as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrysql.llm import minhash, mixing, packing, quality, secrets
from quarrysql.llm.common import table
from quarrysql.session import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects.

    Null and empty texts have the score of no words; repeated rows stay or go together; an empty table stays empty.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five words, similarity 0.8.

    Of a group the smallest id stays, null last. Null and empty texts are no copies of anything; rows equal in id and text count as one.
    """
    return minhash.without_copies(docs, width=5, percent=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; no document is dropped.

    ``n_chars`` is counted anew where a text changed. Null and empty texts stay as they are.
    """
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until sources have their target weights.

    A null source is one of its own; documents without words add none; an empty table stays empty.
    """
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document, copies included, in sequences of 2048 tokens.

    Null and empty texts are pieces of one id; longer texts than a sequence are cut; an empty table gives no piece.
    """
    return packing.report(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: SQL can express neither the trained classifier nor the tokenizer; tests/llm/test_brute_force.py holds run() against brute force.
ORACLE_SQL = None
