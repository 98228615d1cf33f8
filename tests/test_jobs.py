"""The corpus job from files to files."""

import json
from collections import Counter

from quarrysql.plans import jobs
from quarrysql.sources import corpus

LEGACY = "<|system|>\nDialect: sql\nSchema:\nS\n<|end|>\n<|user|>\n{}\n<|end|>\n<|assistant|>\n{}\n<|end|>"


def lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf8")
    return str(path)


def sources(tmp_path):
    first = [{"context": "CREATE TABLE t (a INT)", "question": f"q{i}", "answer": f"SELECT YEAR(a) FROM t{i}"} for i in range(20)]
    first += [{"context": "", "question": f"w{i}", "answer": f"INSERT INTO t VALUES ({i})"} for i in range(3)]
    first += ["{broken", {"question": "m", "answer": "MATCH (n:A) RETURN n"}, {"question": "q1", "answer": "SELECT 2"}]
    second = [{"text": LEGACY.format("legacy question", "SELECT 1 FROM t")}, {"text": LEGACY.format("q2", "SELECT 3 FROM t")}]
    return [
        jobs.Source("one", lines(tmp_path / "one.jsonl", first)),
        jobs.Source("two", lines(tmp_path / "two.jsonl", second), layout="text"),
    ]


def read(path):
    return [json.loads(x) for p in sorted(path.glob("part-*")) for x in p.read_text(encoding="utf8").splitlines()]


def test_build_corpus(spark, tmp_path):
    out = tmp_path / "out"
    jobs.build_corpus(spark, sources(tmp_path), str(out), jobs.Options(dialect="postgres"))
    texts = [r["text"] for r in read(out / "train")]
    # 3 other statements allow int(3 * 0.77 / 0.23) = 10 SELECT rows.
    assert len(texts) == 13 and len(set(texts)) == 13
    assert sum("INSERT INTO" in t for t in texts) == 3
    assert not any("YEAR(a)" in t for t in texts)
    assert all(t.startswith("<|im_start|>system\n") and t.endswith("<|im_end|>\n") for t in texts)
    assert [r["line"] for r in read(out / "quarantine")] == ["{broken"]
    assert [(r["source"], r["reject_reason"], r["n"]) for r in read(out / "rejects")] == [("one", "non_sql", 1)]
    meta = read(out / "metadata")[0]
    assert meta["num_examples"] == 13 and meta["preprocessing"]["dialect"] == "postgres"


def test_first_source_wins_a_question(spark, tmp_path):
    out = tmp_path / "out"
    jobs.build_corpus(spark, sources(tmp_path), str(out), jobs.Options(rebalance=False))
    texts = [r["text"] for r in read(out / "train")]
    assert len(texts) == 24
    assert sum("user\nq2<|im_end|>" in t for t in texts) == 1 and not any("SELECT 3" in t for t in texts)
    assert any("user\nlegacy question<|im_end|>" in t for t in texts)


def test_simple_form_without_dedup(spark, tmp_path):
    out = tmp_path / "out"
    options = jobs.Options(form="simple", rebalance=False, deduplicate=False, validate=False)
    jobs.build_corpus(spark, sources(tmp_path)[:1], str(out), options)
    texts = [r["text"] for r in read(out / "train")]
    assert len(texts) == 25 and all(t.startswith("Schema: ") for t in texts)


def test_encoded_corpus(spark, tmp_path):
    out = tmp_path / "out"
    jobs.build_corpus(spark, sources(tmp_path), str(out), jobs.Options(encode=True, sequence_length=8))
    rows = spark.read.parquet(str(out / "train_tokenized"))
    first = rows.where("window = 0")
    assert {r["split"]: r["count"] for r in first.groupBy("split").count().collect()} == {"train": 11, "validation": 2}
    assert all(len(r["input_ids"]) == 8 for r in rows.collect())
    tokens = {r["token_id"]: r["n"] for r in spark.read.parquet(str(out / "vocabulary")).collect()}
    assert Counter(i for r in rows.collect() for i in r["input_ids"] if i) == tokens


def test_ledger_accounts_for_every_line(spark, tmp_path):
    made = sources(tmp_path)
    made[1] = jobs.Source(made[1].name, made[1].path, made[1].layout, cap=1)
    rows = [{"question": "short", "answer": "SELECT 1"}, {"question": "long", "answer": f"SELECT '{'x' * 3000}'"}, {"question": "e"}]
    made.append(jobs.Source("three", lines(tmp_path / "three.jsonl", rows)))
    jobs.build_corpus(spark, made, str(tmp_path / "out"), jobs.Options())
    found = {(r["source"], r["outcome"]): r["n"] for r in read(tmp_path / "out" / "ledger")}
    total = Counter()
    for (source, _), n in found.items():
        total[source] += n
    assert total == {"one": 26, "two": 2, "three": 3}
    assert sum(n for (_, outcome), n in found.items() if outcome == "final") == read(tmp_path / "out" / "metadata")[0]["num_examples"]
    assert {k: n for k, n in found.items() if k[1] not in ("final", "rebalanced") and k != ("two", "duplicate")} == {
        ("one", "broken"): 1, ("one", "refused: non_sql"): 1, ("one", "duplicate"): 1, ("two", "capped"): 1,
        ("three", "length"): 1, ("three", "refused: empty"): 1,
    }
    assert any(outcome == "rebalanced" for _, outcome in found)


def test_rows_without_a_question_are_no_duplicates(spark, tmp_path):
    answer = "<|im_start|>system\nS<|im_end|>\n<|im_start|>assistant\nSELECT {} FROM t<|im_end|>\n"
    bare = "x" * 120
    rows = [{"text": answer.format(i)} for i in (1, 2)] + [{"text": bare + c} for c in "aba"]
    source = jobs.Source("t", lines(tmp_path / "t.jsonl", rows), layout="text")
    jobs.build_corpus(spark, [source], str(tmp_path / "out"), jobs.Options(rebalance=False))
    texts = [r["text"] for r in read(tmp_path / "out" / "train")]
    assert sum("SELECT 1" in t for t in texts) == 1 and sum("SELECT 2" in t for t in texts) == 1
    assert sorted(t for t in texts if t.startswith("x")) == [bare + "a", bare + "b"]


def test_source_cap(spark, tmp_path):
    capped = [jobs.Source(s.name, s.path, s.layout, cap=5) for s in sources(tmp_path)]
    common, bad = jobs.ingest(spark, capped)
    assert {r["source"]: r["count"] for r in common.groupBy("source").count().collect()} == {"one": 5, "two": 2}
    assert bad.count() == 1


def test_append_instructions(spark):
    current = spark.createDataFrame([(LEGACY.format("Known", "SELECT 1"),)], "text string")
    rows = [(1, "known ", "S", "SELECT 1 FROM t"), (2, "New", "S", 'SELECT "a" FROM t'), (3, "new", "S", "SELECT 2 FROM t"),
            (4, "Other", " ", "SELECT 1 FROM t"), (5, "Bad", "S", "SELECT (1")]
    df = spark.createDataFrame(rows, "row_id long, instruction string, input string, response string")
    out = jobs.append_instructions(current, df).orderBy("part").collect()
    assert [r["text"] for r in out] == [LEGACY.format("Known", "SELECT 1"), LEGACY.format("New", "SELECT 'a' FROM t")]


def test_sources_of_one_name_keep_their_rows_apart(spark, tmp_path):
    made = [jobs.Source("same", lines(tmp_path / f"{k}.jsonl", [{"context": "", "question": k, "answer": "SELECT 1"}])) for k in "ab"]
    common, _ = jobs.ingest(spark, made)
    assert sorted(r.question for r in common.collect()) == ["a", "b"]


def test_without_validation_finished_text_stays(spark, tmp_path):
    texts = [LEGACY.format(f"q{i}", "MATCH (n:A) RETURN n") for i in range(3)]
    made = [jobs.Source("two", lines(tmp_path / "two.jsonl", [{"text": t} for t in texts]), layout="text")]
    common, _ = jobs.ingest(spark, made)
    staged = jobs.stage_rows(common, jobs.Options(dialect="postgres", validate=False)).collect()
    assert sorted(r.text for r in staged) == texts and not any(r.reject_reason for r in staged)


def test_merged_code_keeps_statements_that_differ_late(spark):
    from quarrysql.plans import curation

    listed = ", ".join(f"column_{i}" for i in range(12))
    files = [("a.sql", f"SELECT {listed}, x FROM t;\n\nSELECT {listed}, y FROM t;"), ("b/no_number.sql", f"SELECT {listed}, x FROM t;")]
    files.append(("many.sql", "\n\n".join(f"SELECT c{i} FROM t{i};" for i in range(1_100))))
    made = curation.code_transcripts(spark.createDataFrame([(p, "sql", c) for p, c in files], "path string, ext string, content string"))
    current = spark.createDataFrame([(LEGACY.format("q", "SELECT 1 FROM u"),)], "text string")
    numbered = made.selectExpr("struct(path, stmt_no) AS row_id", "text")
    out = curation.merge_code(current, numbered, "row_id")
    assert out.where("part = 1").count() == 2 + 1_100
    again = curation.merge_code(out.select("text"), numbered, "row_id")
    assert again.where("part = 1").count() == 0
    assert curation.merge_code(current, numbered, "row_id", cap=7).where("part = 1").count() == 7


def test_code_files_join_a_corpus_by_versions(spark, tmp_path):
    first = [{"path": "a.sql", "ext": "sql", "content": "CREATE TABLE t (id INT);\n\nSELECT id FROM t;\n"}, "{broken"]
    second = [{"path": "b.sql", "ext": "sql", "content": "SELECT id FROM t;\n\nDELETE FROM t WHERE id = 1;\n"}, {"path": "c.md", "ext": "md", "content": "SELECT id FROM notes_of_mine;"}]
    base = str(tmp_path / "base")
    assert jobs.merge_code_files(spark, lines(tmp_path / "1.jsonl", first), base) == 1
    before = {r.text for r in corpus.snapshot_read(spark, base).collect()}
    assert sum("SELECT id FROM t" in t for t in before) == 1
    assert jobs.merge_code_files(spark, lines(tmp_path / "2.jsonl", second), base) == 2
    after = [r.text for r in corpus.snapshot_read(spark, base).collect()]
    assert len(after) == len(set(after)) == len(before) + 1 and before < set(after)
    assert any("DELETE FROM t WHERE id = 1" in t for t in after)
    assert {r.text for r in corpus.snapshot_read(spark, base, 1).collect()} == before
    report = read(tmp_path / "base" / "reports" / "version=2" / "files")[0]
    assert (report["files_checked"], report["files_with_sql"]) == (1, 1)
    assert [r["line"] for r in read(tmp_path / "base" / "reports" / "version=1" / "quarantine")] == ["{broken"]


def test_outputs_become_a_leaderboard(spark, tmp_path):
    rows = [
        {"case_id": "1", "category": "JOIN", "model": "v1", "raw_output": "let me see"},
        {"case_id": "1", "category": "JOIN", "model": "v2", "raw_output": "SELECT a FROM t JOIN u ON t.i = u.i"},
        {"case_id": "2", "category": "IN", "model": "v1", "raw_output": "SELECT a FROM t WHERE a IN (1)"},
        {"case_id": "2", "category": "IN", "model": "v2", "raw_output": "SELECT a FROM t WHERE a IN (1)"},
        "{",
    ]
    jobs.score_outputs(spark, lines(tmp_path / "o.jsonl", rows), str(tmp_path / "out"), ["v1", "v2"])
    assert {r["model"] for r in read(tmp_path / "out" / "leaderboard")} == {"v1", "v2"}
    changes = read(tmp_path / "out" / "changes")
    assert [(r["before"], r["after"], r["case_id"], r["change"]) for r in changes] == [("v1", "v2", "1", "now valid")]
    assert len(read(tmp_path / "out" / "quarantine")) == 1 and read(tmp_path / "out" / "comparison")
