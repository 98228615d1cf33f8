"""Reports over tables of generated SQL, one row per case and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.functions.scoring import category_hit, clean_output, looks_like_sql


def evaluated(outputs: DataFrame, rule: str = "checkpoints") -> DataFrame:
    """Cleaned output with its two verdicts."""
    return (
        outputs.withColumn("sql", clean_output("raw_output"))
        .withColumn("is_sql", looks_like_sql("sql", rule))
        .withColumn("has_keyword", category_hit("sql", "category"))
    )


def leaderboard(scored: DataFrame, models: list[str]) -> DataFrame:
    """Hits per model; ``best`` marks the most SQL hits, the first in ``models`` on a tie."""
    board = scored.groupBy("model").agg(
        F.sum(F.col("is_sql").cast("bigint")).alias("sql_hits"),
        F.sum(F.col("has_keyword").cast("bigint")).alias("keyword_hits"),
        F.count("*").alias("total"),
    )
    position = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    # One row per model.
    rank = F.row_number().over(Window.orderBy(F.desc("sql_hits"), position))
    return board.withColumn("best", rank == 1)


def _of_model(model: str, name: str) -> Column:
    """``name`` in the row of ``model``, inside a grouping; null where the model has no row."""
    return F.max(F.when(F.col("model") == model, F.col(name)))


def version_diff(scored: DataFrame, current: str, previous: str) -> DataFrame:
    """Cases that changed, gains and losses. A case without a category is a case like any other."""
    known = ("is_sql", "has_keyword")
    both = scored.where(F.col("model").isin(current, previous)).groupBy("case_id", "category").agg(
        *[_of_model(current, c).alias(f"{c}_cur") for c in known],
        *[_of_model(previous, c).alias(f"{c}_prev") for c in known],
    )
    change = (
        F.when(F.col("is_sql_cur") & ~F.col("is_sql_prev"), "now valid")
        .when(~F.col("is_sql_cur") & F.col("is_sql_prev"), "no longer valid")
        .when(F.col("has_keyword_cur") & ~F.col("has_keyword_prev"), "now has keyword")
        .when(~F.col("has_keyword_cur") & F.col("has_keyword_prev"), "lost keyword")
    )
    return both.select("case_id", "category", change.alias("change")).where(F.col("change").isNotNull())


def pass_rule(scores: DataFrame, base: str, candidate: str, tolerance: Column) -> DataFrame:
    """The candidate passes a case when its score reaches base times tolerance."""
    both = scores.where(F.col("model").isin(base, candidate)).groupBy("case_id").agg(
        _of_model(base, "score").alias("base_score"), _of_model(candidate, "score").alias("candidate_score"),
        *[F.count_if(F.col("model") == m).alias(f"_{i}") for i, m in enumerate((base, candidate))],
    )
    both = both.where("_0 > 0 AND _1 > 0").drop("_0", "_1")
    return both.withColumn("passed", F.col("candidate_score") >= F.col("base_score") * tolerance)


def side_by_side(outputs: DataFrame, base: str, models: list[str], output: str = "raw_output") -> DataFrame:
    """One row per case with the base output and a map from model to output."""

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(output)))

    # One slot per model, combined before the exchange; models without an output leave no entry.
    slots = F.create_map(*[x for m in models for x in (F.lit(m), of(m))])
    return (
        outputs.where(F.col("model").isin(base, *models))
        .groupBy("case_id", "category")
        .agg(of(base).alias("base_output"), F.map_filter(slots, lambda _, v: v.isNotNull()).alias("model_outputs"))
    )


def comparison_table(scored: DataFrame, models: list[str]) -> DataFrame:
    """Verdicts of every model next to each other, one row per case."""
    return scored.groupBy("case_id", "category").pivot("model", models).agg(
        F.max("is_sql").alias("is_sql"), F.max("has_keyword").alias("has_keyword")
    )


def delta_summary(scored: DataFrame, base: str, candidate: str) -> DataFrame:
    """Totals and percents of both models, and the improvement, per measure."""

    def hits(model: str, flag: str) -> Column:
        return F.sum(F.when((F.col("model") == model) & F.col(flag), 1).otherwise(0))

    cases = F.sum((F.col("model") == base).cast("bigint"))
    one = scored.agg(
        cases.alias("cases"),
        F.array(
            *[
                F.struct(
                    F.lit(flag).alias("measure"),
                    hits(base, flag).alias("base_hits"),
                    hits(candidate, flag).alias("candidate_hits"),
                )
                for flag in ("is_sql", "has_keyword")
            ]
        ).alias("m"),
    )
    long = one.select("cases", F.inline("m"))

    def pct(c: Column) -> Column:
        return F.when(F.col("cases") > 0, c * 100.0 / F.col("cases"))

    return (
        long.withColumn("improvement", F.col("candidate_hits") - F.col("base_hits"))
        .withColumn("base_pct", pct(F.col("base_hits")))
        .withColumn("candidate_pct", pct(F.col("candidate_hits")))
        .withColumn("improvement_pct", pct(F.col("improvement")))
    )
