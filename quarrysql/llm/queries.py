"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysql.llm import cosine, fim, language, merkle, minhash, mixing, neighbours, packing, ppm, quality, secrets, sharding, toxicity
from quarrysql.llm.check_sql import CHECK_SQL
from quarrysql.llm.common import is_fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"), shards=24)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"))


def op5_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = toxicity.train(docs, labels)
    scored = docs.select("doc_id", is_fold("doc_id", 5, 0).alias("held_out"), toxicity.scorer(spark, net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_spherical_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.report(table(spark, sf_dir, "documents"), parts=7, held=2)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.train(docs, labels)
    scored = docs.select("doc_id", is_fold("doc_id", 5, 0).alias("held_out"), quality.scorer(spark, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"), parts=4, held=2)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_secret_scan": op2_secret_scan,
    "op3_feistel_shards": op3_feistel_shards,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_collision_counting": op5_collision_counting,
    "op6_toxicity": op6_toxicity,
    "op7_circulant_minhash": op7_circulant_minhash,
    "op8_spherical_kmeans": op8_spherical_kmeans,
    "op9_ppm": op9_ppm,
    "op10_quality": op10_quality,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_language": op12_language,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = CHECK_SQL
