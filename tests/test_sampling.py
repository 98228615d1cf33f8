"""Exact samples, the rebalance rule, splits and shuffles."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quarrysql.operators import sampling


def ids(df):
    return sorted(r["row_id"] for r in df.select("row_id").collect())


def by_hash(values, n, salt):
    return sorted(sorted(values, key=lambda v: (hashlib.md5(f"{salt}|{v}".encode()).hexdigest(), v))[:n])


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("n", [0, 1, 99, 500, 501])
def test_cap_source_is_exact(spark, n, parts):
    df = spark.range(500).withColumnRenamed("id", "row_id").repartition(parts)
    assert ids(sampling.cap_source(df, n)) == by_hash(range(500), n, "cap")


@pytest.mark.parametrize("n", [0, 1, 10, 40])
def test_first_rows_with_ids_per_split(spark, n):
    values = [p * 2**33 + i for p in range(4) for i in range(8)]
    df = spark.createDataFrame([(v,) for v in values], "row_id long").repartition(3)
    assert ids(sampling.first_rows(df, n)) == sorted(values)[:n]


def corpus(spark, selects, others):
    rows = [(i, "SELECT", "SELECT 1") for i in range(selects)]
    rows += [(selects + i, "INSERT", "INSERT 1") for i in range(others)]
    rows += [(selects + others, "EMPTY", "")]
    return spark.createDataFrame(rows, "row_id long, sql_type string, sql string")


@pytest.mark.parametrize("selects, others, kept", [(100, 10, 33), (5, 10, 5), (0, 4, 0), (7, 0, 7), (0, 0, 0)])
def test_rebalance(spark, selects, others, kept):
    out = sampling.rebalance(corpus(spark, selects, others))
    counts = {r["sql_type"]: r["count"] for r in out.groupBy("sql_type").count().collect()}
    assert counts.get("INSERT", 0) == others
    assert counts.get("SELECT", 0) == kept
    assert "EMPTY" not in counts


def test_rebalance_matches_the_documented_count(spark):
    n = 11_789
    df = spark.range(60_000).select(
        F.col("id").alias("row_id"), F.lit("x").alias("sql"), F.when(F.col("id") < n, "INSERT").otherwise("SELECT").alias("sql_type")
    )
    assert sampling.rebalance(df).where("sql_type = 'SELECT'").count() == 39_467


def test_rebalance_refuses_a_full_share(spark):
    with pytest.raises(ValueError):
        sampling.rebalance(corpus(spark, 1, 1), ratio=1.0)


def test_same_rows_under_any_partitioning(spark):
    df = corpus(spark, 100, 10)
    assert ids(sampling.rebalance(df.repartition(1))) == ids(sampling.rebalance(df.repartition(7)))


def test_splits(spark):
    df = spark.range(1005).withColumnRenamed("id", "row_id")
    exact = sampling.train_val_split(df, exact=True).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in exact} == {"validation": 101, "train": 904}
    loose = sampling.train_val_split(df)
    held = ids(loose.where("split = 'validation'"))
    more = sampling.train_val_split(spark.range(2000).withColumnRenamed("id", "row_id"))
    assert held == [i for i in ids(more.where("split = 'validation'")) if i < 1005]


def test_shuffle_is_stable(spark):
    df = spark.range(50).withColumnRenamed("id", "row_id")
    first = [r["row_id"] for r in sampling.shuffle(df.repartition(5)).collect()]
    assert first == [r["row_id"] for r in sampling.shuffle(df).collect()] and first != sorted(first)


def test_report_keeps_every_row(spark):
    before = corpus(spark, 100, 10)
    rows = {r["sql_type"]: r for r in sampling.rebalance_report(before, sampling.rebalance(before)).collect()}
    assert rows["EMPTY"]["n_after"] == 0 and rows["SELECT"]["removed"] == 67


@pytest.mark.parametrize("n", [0, 1, 999, 2_500, 2_999, 3_000, 9_000])
def test_first_rows_with_outliers_and_clusters(spark, monkeypatch, n):
    monkeypatch.setattr(sampling, "FEW", 50)
    values = [*range(1_000), *range(10**15, 10**15 + 1_998), -(2**63), 2**63 - 1]
    sorted_rows = []
    limit = sampling.DataFrame.orderBy
    monkeypatch.setattr(sampling.DataFrame, "orderBy", lambda df, *c, **k: sorted_rows.append(df.count()) or limit(df, *c, **k))
    df = spark.createDataFrame([(v,) for v in values], "row_id long")
    out = sampling.first_rows(df, n)
    assert sorted(r.row_id for r in out.collect()) == sorted(values)[:n]
    assert all(k <= 50 for k in sorted_rows)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def test_samples_are_exact_with_few_rows_to_sort(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FEW", 20)
    df = spark.range(5_000).withColumnRenamed("id", "row_id")
    for n in (0, 1, 2_500, 4_999, 5_000, 6_000):
        assert sampling.cap_source(df, n).count() == min(n, 5_000)
    named = df.selectExpr("struct(row_id AS a, 'x' AS b) AS row_id")
    assert sampling.cap_source(named, 123).count() == 123
