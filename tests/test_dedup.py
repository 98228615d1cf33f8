"""Duplicate removal against sequential models, and under different partitionings."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarrysql.functions.chat import render_legacy
from quarrysql.functions.statements import describe_sql
from quarrysql.operators import dedup, extract


def sequential(rows):
    seen1, seen2, kept = set(), set(), []
    for ord_, a, b in sorted(rows):
        if a not in seen1 and b not in seen2:
            seen1.add(a)
            seen2.add(b)
            kept.append(ord_)
    return kept


def greedy(spark, rows, **kw):
    df = spark.createDataFrame(rows, "row_id long, s string, q string")
    return sorted(r["row_id"] for r in dedup.dedup_greedy(df, "s", "q", **kw).collect())


def test_dropped_rows_register_nothing(spark):
    rows = [(1, "s1", "q1"), (2, "s1", "q2"), (3, "s2", "q2")]
    assert greedy(spark, rows) == [1, 3]
    assert greedy(spark, rows) == [1, 3]


def test_chain_of_five(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, "b", "y"), (4, "b", "z"), (5, "c", "z")]
    assert greedy(spark, rows) == [1, 3, 5]


def test_empty_question_is_a_key(spark):
    assert greedy(spark, [(1, "a", ""), (2, "b", ""), (3, "c", "q")]) == [1, 3]


def test_no_rows(spark):
    assert greedy(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_equals_the_sequential_scan(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"s{rng.randrange(60)}", f"q{rng.randrange(60)}") for i in range(400)]
    # A hot question and a hot statement hold a third of the rows each.
    rows = [(i, "hot" if rng.random() < 0.33 else a, "hot" if rng.random() < 0.33 else b) for i, a, b in rows]
    assert greedy(spark, rows) == sequential(rows)


def test_greedy_with_known_questions(spark):
    known = spark.createDataFrame([("q1",), ("q9",)], "k string")
    rows = [(1, "s1", "q1"), (2, "s1", "q2"), (3, "s2", "q2")]
    assert greedy(spark, rows, existing=known) == [2]


def test_greedy_on_the_given_tables(spark, sf):
    from quarrysql.plans import corpus_queries as queries

    rows = dedup.merge_candidates(queries._chat(spark, sf)).select("row_id", "sql_key", "question_key", "o_orderstatus")
    local = [tuple(r) for r in rows.collect()]
    known = {q for _, _, q, status in local if status == "F" and q}
    want = sequential([(i, s, q) for i, s, q, status in local if status != "F" and q not in known])
    got = sorted(r["row_id"] for r in queries.a36_dedup_greedy(spark, sf).collect())
    assert got == want and got


@pytest.mark.parametrize("parts", [1, 7])
def test_first_wins(spark, parts):
    rows = [(0, 5, "a"), (0, 2, "b"), (1, 1, "a"), (0, 9, "a"), (1, 0, "c")]
    df = spark.createDataFrame(rows, "source_rank int, row_id long, q string").repartition(parts)
    got = sorted((r["q"], r["source_rank"], r["row_id"]) for r in dedup.dedup_first(df, "q").collect())
    assert got == [("a", 0, 5), ("b", 0, 2), ("c", 1, 0)]


def test_first_wins_limits_groups_before_the_exchange(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(1000).select(hot.alias("q"), F.lit(0).alias("source_rank"), F.col("id").alias("row_id"))
    plan = dedup.dedup_first(df, "q")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_prefix(spark):
    rows = [(0, 1, "x" * 200 + "a"), (0, 2, "x" * 200 + "b"), (0, 3, "y")]
    df = spark.createDataFrame(rows, "source_rank int, row_id long, sql string")
    assert sorted(r["row_id"] for r in dedup.dedup_prefix(df, 200).collect()) == [1, 3]


def test_anti_existing_drops_rows_without_a_key(spark):
    new = spark.createDataFrame([(0, 1, "a"), (0, 2, None), (0, 3, "b"), (0, 4, "b")], "source_rank int, row_id long, q string")
    current = spark.createDataFrame([("a",), (None,)], "q string")
    got = dedup.anti_existing(new, current, "q", "q")
    assert [r["row_id"] for r in got.collect()] == [3]


def test_greedy_takes_null_for_a_key(spark):
    rows = [(1, None, "q1"), (2, None, "q2"), (3, "s", "q3"), (4, None, None), (5, "t", None), (6, "u", None)]
    keys = spark.createDataFrame(rows, "ord long, k1 string, k2 string")
    assert sorted(r.ord for r in dedup.greedy_ids(keys).collect()) == [1, 3, 5]
    assert dedup.greedy_ids(keys.limit(0)).count() == 0




def chain(n, name="", first=0):
    return [(first + i, f"{name}a{(i + 1) // 2}", f"{name}b{i // 2}") for i in range(n)]


def steps_of(monkeypatch):
    """Counts the rounds of the two-key rule, and those of the search for components."""
    from quarrysql.operators import components

    seen, write, star = Counter(), dedup.written, components._small_star

    def writing(df, label):
        seen[label] += 1
        return write(df, label)

    def starred(df):
        seen["star"] += 1
        return star(df)

    monkeypatch.setattr(dedup, "written", writing)
    monkeypatch.setattr(components, "_small_star", starred)
    return seen


def test_a_long_chain_ends_in_few_rounds(spark, monkeypatch):
    seen, rows = steps_of(monkeypatch), chain(10_000)
    keys = spark.createDataFrame(rows, "ord long, k1 string, k2 string")
    assert sorted(r.ord for r in dedup.greedy_ids(keys).collect()) == sequential(rows)
    assert seen["kept"] == 4 and seen["settled"] == 1 and seen["star"] == 0


def test_chains_are_settled_apart(spark, monkeypatch):
    seen, rows = steps_of(monkeypatch), [r for k in range(3) for r in chain(1_000, f"{k}-", k * 5_000)]
    keys = spark.createDataFrame(rows, "ord long, k1 string, k2 string")
    assert sorted(r.ord for r in dedup.greedy_ids(keys, rounds=1, settled=1_200).collect()) == sequential(rows)
    assert seen["kept"] == 1 and seen["settled"] == 1 and 0 < seen["star"] <= 16


def test_components_larger_than_one_step_go_on_in_rounds(spark):
    rng = random.Random(7)
    rows = chain(12) + [(1_000 + i, f"s{rng.randrange(30)}", f"q{rng.randrange(30)}") for i in range(200)]
    keys = spark.createDataFrame(rows, "ord long, k1 string, k2 string")
    assert sorted(r.ord for r in dedup.greedy_ids(keys, rounds=1, settled=3).collect()) == sequential(rows)


def test_half_the_rows_without_a_question(spark, monkeypatch):
    """No exchange gathers the rows of a hot key: counted where rows meet what their keys tell them."""
    from quarrysql.operators import skew

    n = 20_000
    keys = spark.range(n, numPartitions=8).select(
        F.col("id").alias("ord"), F.concat(F.lit("s"), (F.col("id") % 9_973).cast("string")).alias("k1"),
        F.when(F.col("id") % 2 == 0, "").otherwise(F.concat(F.lit("q"), (F.col("id") % 9_001).cast("string"))).alias("k2"),
    )
    most = []
    join = skew.join_null_safe

    def counted(left, right, on, how="inner"):
        out = join(left, right, on, how)
        if "_apart" in on:
            sizes = sorted(r["count"] for r in left.repartition(8, *on).groupBy(F.spark_partition_id()).count().collect())
            if sum(sizes) > 5_000:
                most.append(sizes[-1] / sizes[len(sizes) // 2])
        return out

    monkeypatch.setattr(skew, "join_null_safe", counted)
    found = sorted(r.ord for r in dedup.greedy_ids(keys).collect())
    assert found == sequential([tuple(r) for r in keys.collect()])
    assert most and max(most) < 3


def test_components_of_paths_and_hubs(spark):
    from quarrysql.operators.components import components

    edges = [(i, i + 1) for i in range(100, 160)] + [(9_000, k) for k in range(9_001, 9_300)] + [(7, 7), (5, 6), (6, 5)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{k: 100 for k in range(101, 161)}, **{k: 9_000 for k in range(9_001, 9_300)}, 6: 5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_question_keys_are_computed_once_a_row(spark):
    long = ", ".join(f"column_{i}" for i in range(12))
    asked = "Get the names of all customers and the dates of their orders from the shop"
    sqls = ["SELECT a FROM t", f"SELECT {long} FROM t", f"SELECT {long}, z FROM t", "DELETE FROM t WHERE a = 1", "DROP TABLE t"]
    made = spark.createDataFrame(list(enumerate(sqls)), "i int, sql string").withColumn("asked", describe_sql("sql"))
    rows = made.unionByName(spark.createDataFrame([(5, "SELECT 1 FROM t", asked)], "i int, sql string, asked string"))
    texts = rows.select("i", render_legacy(F.lit(""), "asked", "sql").alias("text")).unionByName(
        spark.createDataFrame([(6, None), (7, "no turn")], "i int, text string")
    )
    found = dedup.question_keys(texts)
    assert [r.question_key for r in found.orderBy("i").collect()] == [
        "get a from t", f"get {long} from t", f"get {long}, z from t", "delete records from t", "execute this sql query", asked.lower(), "", "",
    ]
    plan = found.where("question_key <> ''").select("question_key")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1  # no filter holds a copy of the patterns


def test_spans_of_statements_are_those_of_the_pattern():
    pattern = re.compile(r"(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|WITH)\s+.*?(?:;|(?=\n\n|\Z))", re.I | re.S)
    parts = ["select", "SELECT ", "with\n\n", "drop", " ", "\n", "\n\n", ";", "x", "create table t (a int)", "\t", " ;"]
    dice = random.Random(3)
    for _ in range(5_000):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(0, 14)))
        assert list(extract.spans_in(text)) == [m.span() for m in pattern.finditer(text)]
