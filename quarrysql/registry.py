"""All registered queries by name, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from quarrysql.checks.corpus_sql import CORPUS_SQL
from quarrysql.checks.pattern_sql import PATTERN_SQL
from quarrysql.plans.corpus_queries import QUERIES, flagship
from quarrysql.plans.derived import table
from quarrysql.plans.patterns import PATTERNS

Query = Callable[[SparkSession, str], DataFrame]


def _pattern(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(partial(table, spark, sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {**QUERIES, **{name: _pattern(fn) for name, fn in PATTERNS.items()}}


def oracle_sql() -> dict[str, str]:
    return {**CORPUS_SQL, **PATTERN_SQL}


__all__ = ["flagship", "oracle_sql", "queries"]
