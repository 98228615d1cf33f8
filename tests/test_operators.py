"""Sources, extraction, encoding, windows, profiles, checks and scores on small inputs."""

import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrysql.functions.text import compute_once
from quarrysql.operators import encode, extract, profile, quality, score, windows
from quarrysql.plans import curation, patterns
from quarrysql.session import scratch_path
from quarrysql.sources import corpus


def test_jsonl_round_trip(spark, tmp_path):
    lines = ['{"text": "café 日"}', "", "  ", '{"text": 5}', "{broken", '{"other": 1}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n", encoding="utf8")
    good, bad = corpus.read_jsonl(spark, str(tmp_path / "in.jsonl"), corpus.LAYOUTS["text"])
    assert sorted([r["text"] or "" for r in good.collect()]) == ["", "5", "café 日"]
    assert [r["line"] for r in bad.collect()] == ["{broken"] and bad.count() == 1
    assert bad.first()["file_path"].endswith("in.jsonl")
    parsed = corpus.parse_jsonl(spark, str(tmp_path / "in.jsonl"), corpus.LAYOUTS["text"])
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") == 1
    corpus.write_text_jsonl(good, str(tmp_path / "out"))
    written = "".join(p.read_text(encoding="utf8") for p in (tmp_path / "out").glob("part-*"))
    assert '"café 日"' in written


def test_common_row_of_each_layout(spark):
    for layout, row in {
        "context_qa": {"context": "S", "question": "Q", "answer": "A"},
        "prompt_sql": {"sql_context": "S", "sql_prompt": "Q", "sql": "A"},
        "instruction": {"input": "S", "instruction": "Q", "response": "A"},
    }.items():
        df = spark.createDataFrame([row], corpus.LAYOUTS[layout])
        assert tuple(corpus.to_common(df, keep=()).first()) == ("S", "Q", "A")
    df = spark.createDataFrame([{"user_prompt": "Q", "sql_query": "A"}], corpus.LAYOUTS["parameters"])
    assert tuple(corpus.to_common(df, keep=()).first()) == ("", "Q", "A")


def test_snapshots(spark):
    base = scratch_path(spark, "snap")
    with pytest.raises(FileNotFoundError):
        corpus.snapshot_read(spark, base)
    assert corpus.snapshot_write(spark.range(3), base) == 1
    assert corpus.snapshot_write(corpus.snapshot_read(spark, base).union(spark.range(2)), base) == 2
    # Data without a commit does not count.
    spark.range(100).write.parquet(f"{base}/data/left-over")
    assert corpus.snapshot_read(spark, base).count() == 5
    assert corpus.snapshot_write(spark.range(1), base) == 3
    assert corpus.snapshot_read(spark, base, 1).count() == 3
    with pytest.raises(FileNotFoundError):
        corpus.snapshot_read(spark, base, 9)


def test_two_writers_of_one_version(spark):
    base = scratch_path(spark, "snap")
    corpus.snapshot_write(spark.range(3), base)
    first, second = spark.range(4), spark.range(7)
    assert corpus.snapshot_write(first, base, after=1) == 2
    with pytest.raises(corpus.VersionTaken):
        corpus.snapshot_write(second, base, after=1)
    assert corpus.snapshot_read(spark, base).count() == 4

    def attempt(n):
        try:
            return corpus.snapshot_write(spark.range(n), base, after=2)
        except corpus.VersionTaken:
            return None

    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(attempt, range(10, 16)))
    assert sorted(x for x in got if x) == [3]
    assert corpus.snapshot_read(spark, base).count() == 10 + got.index(3)


def brute_statements(content):
    """Every statement with the last table definition found in the text before it."""
    verbs = r"(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|WITH)\s+.*?(?:;|(?=\n\n|\Z))"
    table = r"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\w+)\s*\([^)]+\)"
    out = []
    for m in re.finditer(verbs, content, re.I | re.S):
        sql = m.group(0).strip().rstrip(";").strip()
        if len(sql) >= 10:
            before = [t.group(0).strip() for t in re.finditer(table, content[: m.start()], re.I | re.S)]
            out.append((before[-1] if before else "", sql))
    return out + [(t.group(0).strip(), t.group(0).strip()) for t in re.finditer(table, content, re.I | re.S)]


FILES = [
    "CREATE TABLE a (x INT);\nselect x from a;\n\nCREATE TABLE b (y INT\n\nSELECT y FROM b\n\nDROP TABLE zz;;",
    "x = 1\nq = 'DELETE FROM t WHERE a = 1'\n\nSELECT 1;",
    "create table if not exists c (a INT, b DECIMAL(1)); INSERT INTO c VALUES (1); UPDATE c SET a = 2",
    "nothing here at all, really nothing",
    "CREATE TABLE d (a\n\nCREATE TABLE e (b INT) SELECT * FROM d WHERE updated  \n",
    "create table f (); CREATE TABLE IF (x); create table if not exists\tg\n( y ); CREATE TABLE h (z",
]


def test_extract_statements(spark):
    df = spark.createDataFrame([(f"f{i}.sql", c) for i, c in enumerate(FILES)], "path string, content string")
    rows = extract.extract_statements(df).orderBy("path", "stmt_no").collect()
    for i, content in enumerate(FILES):
        got = [(r["schema_ddl"], r["sql"]) for r in rows if r["path"] == f"f{i}.sql"]
        assert got == brute_statements(content)
    assert {r["type"] for r in rows} >= {"create", "select", "delete", "schema"}


def test_unfinished_definitions_take_linear_time():
    assert len(list(extract.statements_in("CREATE TABLE t (a INT;\n" * 100_000))) == 100_000


def test_select_sql_files(spark):
    rows = [("a.py", "py", "SELECT 1 FROM t WHERE x = 1"), ("b", "SQL", " SELECT 1 FROM t WHERE x = 1 "),
            ("sql/c.txt", "txt", "x" * 20), ("d.db", "db", "short      " + " " * 30)]
    df = spark.createDataFrame(rows, "path string, ext string, content string")
    got = {r["path"]: r["content"] for r in extract.select_sql_files(df).collect()}
    assert got == {"b": "SELECT 1 FROM t WHERE x = 1", "sql/c.txt": "x" * 20}


def test_scan_budget(spark):
    rows = [(i, f"{i}.sql", "sql", "SELECT a FROM t WHERE b = 1;" if i % 2 else "nothing at all in this file") for i in range(40)]
    df = spark.createDataFrame(rows, "file_id long, path string, ext string, content string")
    assert sorted(r["file_id"] for r in extract.scan_budget(df, 3).collect()) == [1, 3, 5]
    # The fourth file uses up the budget and is not read.
    assert sorted(r["file_id"] for r in extract.scan_budget(df, 3, max_check=4).collect()) == [1]


@pytest.mark.parametrize("chunk", [1, 9, 1_000_000])
def test_encode_whole_texts_in_windows(spark, monkeypatch, chunk):
    monkeypatch.setattr(encode, "CHUNK", chunk)
    docs = [(1, "b a  a\tc"), (2, "a b   d"), (3, " "), (4, "a a a a a a a a"), (5, None), (6, "\x1fe\u2003f\xa0a\u3000g b"), (7, "a b c d e")]
    df = spark.createDataFrame(docs, "id long, text string").repartition(3)
    vocabulary = encode.build_vocabulary(df)
    counts = Counter(w for _, t in docs for w in (t or "").split())
    order = sorted(counts, key=lambda w: (-counts[w], w))
    number = {w: i + 1 for i, w in enumerate(order)}
    assert {r["token"]: r["token_id"] for r in vocabulary.collect()} == number
    found = {(r["id"], r["window"]): r for r in encode.encode_fixed(df, vocabulary, "id", max_len=5).collect()}
    ids = {i: [number[w] for w in (t or "").split()] for i, t in docs}
    want = {(i, k): own[5 * k : 5 * k + 5] for i, own in ids.items() for k in range(max(1, -(-len(own) // 5)))}
    assert found.keys() == want.keys()
    for key, own in want.items():
        r = found[key]
        assert r["input_ids"] == own + [0] * (5 - len(own)) == r["labels"]
        assert r["attention_mask"] == [1] * len(own) + [0] * (5 - len(own))
    few = encode.encode_fixed(df, vocabulary.where("token <> 'a'"), "id", max_len=5).where("id = 4").collect()
    assert [(r["window"], sum(r["attention_mask"])) for r in few] == [(0, 0)]
    assert encode.encode_fixed(df.limit(0), vocabulary, "id").count() == 0


def ranks(values):
    ordered = sorted(values)
    distinct = sorted(set(values))
    return {v: (ordered.index(v) + 1, distinct.index(v) + 1) for v in values}


def test_ranks_with_ties_and_a_null_key(spark):
    rows = [(k, v, i) for i, (k, v) in enumerate([("a", 3), ("a", 1), ("a", 3), ("a", 17), ("b", 5), (None, 2), (None, 2)])]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    out = windows.ranked(df, ["k"], "v", tie_break="i").collect()
    assert len(out) == len(rows)
    for key in ("a", "b", None):
        want = ranks([v for k, v, _ in rows if k == key])
        mine = [r for r in out if r["k"] == key]
        assert all((r["rank"], r["dense_rank"]) == want[r["v"]] for r in mine)
        assert sorted(r["row_number"] for r in mine) == list(range(1, len(mine) + 1))


def test_running_total(spark):
    rows = [("a", 1, 10), ("a", 1, 5), ("a", 9, 1), ("b", 2, 7), (None, 3, 4), ("a", 5, None)]
    df = spark.createDataFrame(rows, "k string, t int, x int")
    out = windows.running_total(df, ["k"], "t", F.col("x")).collect()
    for r in out:
        want = sum(x or 0 for k, t, x in rows if k == r["k"] and t <= r["t"])
        assert r["running_total"] == want
    assert len(out) == len(rows)


@pytest.mark.parametrize("parts, batch", [("1", "10000"), ("7", "3"), ("16", "10")])
def test_windows_over_a_hot_group_and_a_hot_tie(spark, parts, batch):
    """Half the rows in one group, a third of all in one tie, against plain windows."""
    shuffle, held = "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = {c: spark.conf.get(c) for c in (shuffle, held)}
    group = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 1, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 11).cast("string")))
    value = F.when(F.col("id") % 3 == 0, 50).when(F.col("id") % 17 == 1, None).otherwise(F.col("id") % 97)
    amount = F.when(F.col("id") % 5 > 0, ((F.col("id") * 37) % 101 - 50).cast("decimal(12,2)") / 4).cast("decimal(12,2)")
    df = spark.range(1_500).select("id", group.alias("k"), value.alias("v"), amount.alias("x"))
    try:
        spark.conf.set(shuffle, parts)
        spark.conf.set(held, batch)
        for keys, down in ((["k"], False), (["k"], True), ([], False)):
            w = Window.partitionBy(*keys).orderBy(F.desc("v") if down else F.asc("v"))
            by_id = Window.partitionBy(*keys).orderBy(F.desc("v") if down else F.asc("v"), "id")
            want = df.select("id", F.rank().over(w), F.dense_rank().over(w), F.row_number().over(by_id)).collect()
            found = windows.ranked(df, keys, "v", tie_break="id", descending=down)
            assert sorted(map(tuple, found.select("id", "rank", "dense_rank", "row_number").collect())) == sorted(map(tuple, want))
        for keys in (["k"], []):
            want = df.select("id", F.coalesce(F.sum("x").over(Window.partitionBy(*keys).orderBy("v")), F.lit(0))).collect()
            found = windows.running_total(df, keys, "v", F.col("x"))
            assert sorted(map(tuple, found.select("id", "running_total").collect())) == sorted(map(tuple, want))
        sizes = [r["count"] for r in spark.read.parquet(*found.inputFiles()).groupBy("_part").count().collect()]
        assert len(sizes) == int(parts) and max(sizes) < 3 * 1_500 / int(parts)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") <= 3
        assert windows.running_total(df.limit(0), ["k"], "v", F.col("x")).count() == 0
        with pytest.raises(TypeError):
            windows.running_total(df, ["k"], "v", F.col("x").cast("double"))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_not_in_rules(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")

    def kept(values):
        other = spark.createDataFrame([(v,) for v in values], "b int")
        return sorted((r["a"] for r in patterns.not_in(df, "a", other, "b").collect()), key=str)

    assert kept([2]) == [1]
    assert kept([2, None]) == []
    assert kept([]) == [1, 2, None]


EMPTY = "row_id long, source string, question string, schema_ddl string, sql string, sql_type string, text string"


def test_empty_corpus_through_every_profile_and_check(spark):
    df = spark.createDataFrame([], EMPTY)
    assert profile.type_distribution(df).count() == 0
    assert profile.category_rollup(df).count() == 0
    assert profile.balance_verdict(df).first()["n"] == 0
    assert [r["n"] for r in profile.pattern_counts(df).collect()] == [0] * 6
    assert profile.feature_rates(df).first()["n"] == 0
    assert profile.overlap(df, df, "question", "question").first()["overlap_rate"] == 0.0
    assert profile.label_distribution(df, "source").count() == 0
    assert tuple(quality.readiness(df).first())[:2] == (0, None)
    assert quality.residue_verdict(quality.dialect_residue(df)).first()["verdict"] == "clean"
    checked = df.withColumn("issues", F.array().cast("array<string>"))
    assert [tuple(r) for r in quality.issue_report(checked).collect()] == [("all valid", 0)]
    assert corpus.corpus_metadata(df, {"dialect": "sql"}, split=None).first()["num_examples"] == 0
    assert curation.curate(df.withColumn("source_rank", F.lit(0))).count() == 0


def test_overlap_may_pass_one_hundred(spark):
    new = spark.createDataFrame([("A ",), ("a",), ("",), (None,)], "q string")
    cur = spark.createDataFrame([("a",)], "q string")
    row = profile.overlap(new, cur, "q", "q").first()
    assert (row["new_unique"], row["overlapping_rows"], row["overlap_rate"], row["unique_overlap_rate"]) == (1, 2, 200.0, 100.0)


def test_detect_roles():
    names = ["id", "domain", "sql_complexity", "sql_task_type", "sql_prompt", "sql_context", "sql"]
    assert profile.detect_roles(names) == {
        "sql": "sql", "question": None, "schema": "sql_context", "overlap_question": "sql_prompt",
    }
    assert profile.detect_roles(["instruction", "input", "response", "source", "text"]) == {
        "sql": "response", "question": "instruction", "schema": "input", "overlap_question": "text",
    }


def test_row_checks(spark):
    legacy = "<|system|>\nDialect: sql\nSchema:\nS\n<|end|>\n<|user|>\nQ\n<|end|>\n<|assistant|>\nSELECT 1\n<|end|>"
    rows = [(legacy, "c", "q", "SELECT 1"), ("x", "c", " ", ""), (legacy, None, "q", "a"), (legacy + "x" * 2048, "c", "q", "a")]
    df = spark.createDataFrame(rows, "text string, context string, question string, answer string")
    found = [r["issues"] for r in quality.row_checks(df).collect()]
    assert found[0] == [] and found[2] == ["missing_fields"] and found[3] == ["too_long"]
    assert found[1] == ["no_system", "no_schema", "no_user", "no_assistant", "few_end_tags", "empty_sql",
                        "empty_question", "too_short"]


def test_sample_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "row_id").repartition(4)
    assert [r["row_id"] for r in quality.sample_rows(df, F.col("row_id") % 2 == 1, 3).collect()] == [1, 3, 5]
    assert [r["row_id"] for r in quality.rows_at(df, [9, 0, 100]).collect()] == [0, 9]


@pytest.mark.parametrize("length, kept", [(9, False), (10, True), (2048, True), (2049, False)])
def test_length_filter(spark, length, kept):
    df = spark.createDataFrame([("x" * length,)], "text string")
    assert (curation.length_filter(df).count() == 1) is kept


def test_leaderboard_tie_goes_to_the_first_model(spark):
    rows = [("m2", True, False), ("m1", True, True), ("m3", False, True)]
    df = spark.createDataFrame(rows, "model string, is_sql boolean, has_keyword boolean")
    best = [r["model"] for r in score.leaderboard(df, ["m1", "m2", "m3"]).collect() if r["best"]]
    assert best == ["m1"]


def test_rebuild_keeps_rows_without_an_answer(spark):
    df = spark.createDataFrame([(1, "plain"), (2, "<|user|>Q<|end|><|assistant|>MATCH (n:A) RETURN n<|end|>")], "row_id long, text string")
    rows = {r["row_id"]: r for r in curation.rebuild_text(df).collect()}
    assert rows[1]["text"] == "plain" and rows[1]["reject_reason"] is None
    assert rows[2]["text"] == "" and rows[2]["reject_reason"] == "non_sql" and rows[2]["question"] == "Q"


def test_unused_generated_column_does_not_block_pushdown(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    df = compute_once(orders, x=F.upper("o_orderstatus")).where("o_orderstatus = 'F'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan


def test_patterns_build_no_product(spark, sf):
    def tables(name):
        return spark.read.parquet(f"{sf}/{name}.parquet")

    for name, fn in patterns.PATTERNS.items():
        plan = fn(tables)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_hot_group_is_not_exchanged(spark, monkeypatch):
    from quarrysql.operators import skew

    monkeypatch.setattr(skew, "HOT_GROUPS", 3)
    rows = [("hot", i) for i in range(50)] + [(f"k{i}", i) for i in range(40)] + [(None, 1), (None, 2)]
    top = {k: max(x for j, x in rows if j == k) for k, _ in rows}
    df = spark.createDataFrame(rows, "k string, x int")
    out = skew.with_group_values(df, ["k"], top=F.max("x"))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr((k, x, top[k])) for k, x in rows)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2
    groups = df.groupBy("k").agg(F.max("x").alias("top"), F.count("*").alias("n")).where("k IS NULL OR k <> 'k7'")
    met = skew.look_up(df, groups, ["k"], "n")
    assert sorted(map(repr, map(tuple, met.collect()))) == sorted(repr((k, x, None if k == "k7" else top[k])) for k, x in rows)



def test_reports_pair_models_without_a_join(spark):
    from quarrysql.operators import score

    rows = [(1, None, "a", True, False, 0.5), (1, None, "b", False, True, 0.7), (2, "x", "a", True, True, 1.0)]
    rows += [(3, "y", "a", True, False, None), (3, "y", "b", True, True, 0.2), (3, "y", "c", False, False, 0.1)]
    df = spark.createDataFrame(rows, "case_id int, category string, model string, is_sql boolean, has_keyword boolean, score double")
    diff = {(r["case_id"], r["category"]): r["change"] for r in score.version_diff(df, "a", "b").collect()}
    assert diff == {(1, None): "now valid", (3, "y"): "lost keyword"}
    out = score.pass_rule(df, "b", "a", F.lit(0.8))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0.7, 0.5, False), (3, 0.2, None, None)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_statements_that_differ_late_are_kept(spark):
    long = "SELECT '" + "x" * 300 + "'"
    rows = [("a", 0, long, "I"), ("b", 0, long + " AS y", "I"), ("c", 0, long, "I")]
    df = spark.createDataFrame(rows, "path string, stmt_no int, sql string, instruction string")
    assert sorted(r["path"] for r in curation.accepted_statements(df).collect()) == ["a", "b"]
