"""The corpus operators as runnable queries (A01-A78) over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysql.functions import chat, scoring, statements
from quarrysql.functions.text import compute_once, lower_strip
from quarrysql.operators import dedup, encode, extract, profile, quality, sampling, score
from quarrysql.plans import curation
from quarrysql.plans.derived import MODELS, derived, spread, table
from quarrysql.session import scratch_path, written
from quarrysql.sources import corpus

QUERIES: dict = {}


def query(fn):
    """Registers ``fn(spark, sf_dir)`` under its own name."""
    QUERIES[fn.__name__] = fn
    return fn


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "corpus_raw")


def _chat(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "chat")


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).withColumn("sql_type", statements.sql_type("sql"))


def _current(df: DataFrame) -> DataFrame:
    return df.where(F.col("o_orderstatus") == "F")


def _incoming(df: DataFrame) -> DataFrame:
    return df.where(F.col("o_orderstatus") != "F")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return score.evaluated(derived(spark, sf, "outputs"))


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "code_files")


def _found(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_statements(extract.select_sql_files(_files(spark, sf)))


def rows(name: str, source, columns, key: tuple[str, ...] = ("row_id",)) -> None:
    """Registers a query that adds computed columns, a dict made on demand, to the key of every row."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = source(spark, sf)
        return base.select(*key, *[c.alias(n) for n, c in columns().items()])

    QUERIES[name] = run


# --- sources and sinks -----------------------------------------------------------------------


@query
def a01_read_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written by Spark, some cut short and some blank, read back in two parts."""
    rows = _chat(spark, sf)
    whole = F.to_json(F.struct(F.col("row_id").alias("id"), "text"))
    cut = F.concat(F.lit('{"id": '), F.col("row_id").cast("string"), F.lit(', "text": "cut'))
    line = F.when(F.col("row_id") % 13 == 5, cut).otherwise(whole)
    path = scratch_path(spark, "lines")
    rows.select(F.explode(F.array(line, F.lit(""))).alias("value")).write.text(path)
    schema = corpus.T.StructType.fromDDL("id long, text string")
    good, bad = corpus.read_jsonl(spark, path, schema)
    good = good.select("id", "text", F.lit(None).cast("string").alias("broken"))
    bad = bad.select(F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"), F.col("line").alias("broken"))
    return good.unionByName(bad)


def _layouts(spark: SparkSession, sf: str) -> list[DataFrame]:
    """One frame per source, each in a layout of its own."""
    raw = _raw(spark, sf)
    ids = ("source", "source_rank", "row_id")

    def of(source: str, schema: str, question: str, sql: str) -> DataFrame:
        return raw.where(F.col("source") == source).select(
            *ids, F.col("schema_ddl").alias(schema), F.col("question").alias(question), F.col("sql").alias(sql)
        )

    return [
        of("synthetic", "context", "question", "answer"),
        of("community", "sql_context", "sql_prompt", "sql"),
        of("fixes", "input", "instruction", "response"),
    ]


@query
def a02_to_common(spark: SparkSession, sf: str) -> DataFrame:
    """All layouts side by side in one wide frame; the first non-empty column wins."""
    wide = corpus.merge_sources(_layouts(spark, sf))
    return corpus.to_common(wide).select("row_id", "source", "schema_ddl", "question", "sql")


@query
def a03_merge_sources(spark: SparkSession, sf: str) -> DataFrame:
    merged = corpus.merge_sources([corpus.to_common(df) for df in _layouts(spark, sf)])
    return merged.select("row_id", "source", "source_rank", "schema_ddl", "question", "sql")


@query
def a04_cap_source(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.cap_source(_raw(spark, sf), 1000).select("row_id", "sql")


@query
def a04_first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.first_rows(_raw(spark, sf), 1000).select("row_id", "sql")


@query
def a05_write_text_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "text")
    corpus.write_text_jsonl(_chat(spark, sf), path)
    return corpus.read_jsonl(spark, path, corpus.LAYOUTS["text"])[0]


@query
def a06_corpus_metadata(spark: SparkSession, sf: str) -> DataFrame:
    params = {"source_dataset": "orders", "dialect": "postgres", "format": "chat"}
    split = sampling.train_val_split(_chat(spark, sf))
    return corpus.corpus_metadata(split, params).select("preprocessing.*", "*").drop("preprocessing")


@query
def a07_write_columnar(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "columnar")
    corpus.write_columnar(sampling.train_val_split(_chat(spark, sf)).select("row_id", "text", "split"), path)
    return spark.read.parquet(path).select("row_id", "text", "split")


@query
def a08_select_sql_files(spark: SparkSession, sf: str) -> DataFrame:
    return extract.select_sql_files(_files(spark, sf)).select("file_id", "path", "content")


@query
def a09_scan_budget(spark: SparkSession, sf: str) -> DataFrame:
    return extract.scan_budget(_files(spark, sf), limit=100).select("file_id", "path")


@query
def a10_snapshot_write(spark: SparkSession, sf: str) -> DataFrame:
    """The current part as version 1; version 2 reads version 1 and adds the rest."""
    base = scratch_path(spark, "snapshot")
    rows = _chat(spark, sf).select("row_id", "text", "o_orderstatus")
    corpus.snapshot_write(_current(rows), base)
    version = corpus.snapshot_write(corpus.snapshot_read(spark, base).unionByName(_incoming(rows)), base)
    return corpus.snapshot_read(spark, base).select("row_id", "text", F.lit(version).alias("version"))


# --- chat extraction and formatting ----------------------------------------------------------

rows("a11_assistant_sql", _chat, lambda: {
    "sql": chat.assistant_sql("text"), "strict_sql": chat.assistant_sql_strict("text")})
rows("a12_user_question", _chat, lambda: {
    "question": chat.user_question("text"), "merge_key": chat.legacy_question_key("text"),
    "rebuilt": chat.rebuilt_question("text")})
rows("a13_system_content", _chat, lambda: {"system": chat.system_content("text")})
rows("a14_strip_reasoning", _chat, lambda: {"sql": statements.strip_reasoning(chat.assistant_sql("text"))})
rows("a15_chat_format", _chat, lambda: {"format": chat.chat_format("text")})


@query
def a16_extract_statements(spark: SparkSession, sf: str) -> DataFrame:
    return _found(spark, sf).select("path", "stmt_no", "instruction", "sql", "type")


@query
def a17_schema_context(spark: SparkSession, sf: str) -> DataFrame:
    return _found(spark, sf).select("path", "stmt_no", "schema_ddl")


rows("a18_describe_sql", _raw, lambda: {"instruction": statements.describe_sql("sql")})
rows("a19_canonicalize_schema", _raw, lambda: {"schema_ddl": statements.canonicalize_schema("schema_ddl")})
rows("a20_reasoning_line", _raw, lambda: {"reasoning": chat.reasoning_line("sql")})
rows("a21_render_chat", _raw, lambda: {
    "text": chat.render_chat("schema_ddl", "question", "sql", "sql", chat.reasoning_mix("row_id"))})
rows("a22_render_legacy", _raw, lambda: {
    "legacy": chat.render_legacy("schema_ddl", "question", "sql"),
    "simple": chat.render_simple("schema_ddl", "question", "sql")})
rows("a23_reasoning_mix", _raw, lambda: {"with_reasoning": chat.reasoning_mix("row_id")})


@query
def a24_rebuild_text(spark: SparkSession, sf: str) -> DataFrame:
    # The check rewrites nothing, so the gate runs on the text as it is.
    return curation.rebuild_text(_chat(spark, sf)).select("row_id", "question", "reject_reason", "text")


@query
def a25_encode_fixed(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(table(spark, sf, "documents"), "doc_id")
    encoded = encode.encode_fixed(documents, encode.build_vocabulary(documents), "doc_id")
    total = F.size(F.array_remove("attention_mask", 0)).cast("bigint")
    return encoded.select(
        "doc_id", F.col("window").cast("bigint").alias("window"), F.array_join("input_ids", " ").alias("input_ids"), total.alias("mask_sum"),
        F.size("labels").cast("bigint").alias("label_count"),
    )


# --- cleaning, dialect, gates ----------------------------------------------------------------

rows("a26_mysql_to_postgres", _raw, lambda: {"sql": statements.mysql_to_postgres("sql")})
rows("a27_sqlite_to_postgres", _raw, lambda: {"sql": statements.sqlite_to_postgres("sql")})
rows("a28_is_non_sql", _raw, lambda: {
    "non_sql": statements.is_non_sql("sql"), "non_sql_compat": statements.is_non_sql("sql", compat=True)})


@query
def a29_statement_gate(spark: SparkSession, sf: str) -> DataFrame:
    gated = compute_once(_raw(spark, sf), sql=statements.gated_sql("sql", "postgres"))
    generic = statements.gate(statements.gate(gated), reason="generic_reason", lint=False, compat=True)
    return generic.select("row_id", "sql", "reject_reason", "generic_reason")


@query
def a29_gate_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Statements on which a gate may err; the check holds the verdicts of a reader, not a gate of its own."""
    return statements.gate(derived(spark, sf, "gate_cases")).select("row_id", "reject_reason")


@query
def a30_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = curation.length_filter(table(spark, sf, "documents"))
    return kept.select("doc_id", F.length("text").cast("bigint").alias("len"))


@query
def a31_required_fields(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.required_fields(_raw(spark, sf), ("question", "sql", "schema_ddl")).select("row_id")


@query
def a32_english_only(spark: SparkSession, sf: str) -> DataFrame:
    return curation.english_only(table(spark, sf, "documents"), language="lang").select("doc_id", "source")


@query
def a32_english_by_words(spark: SparkSession, sf: str) -> DataFrame:
    return curation.english_only(spread(table(spark, sf, "documents"), "doc_id")).select("doc_id")


rows("a33_sanitize_answer", _raw, lambda: {"sql": statements.sanitize_answer("sql")})


# --- dedup and merge -------------------------------------------------------------------------


@query
def a34_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_first(_raw(spark, sf), "question").select("row_id", "question")


def _new_questions(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    return dedup.anti_existing(_incoming(raw), _current(raw), lower_strip("question"), lower_strip("question"))


@query
def a35_anti_existing(spark: SparkSession, sf: str) -> DataFrame:
    return _new_questions(spark, sf).select("row_id", "question")


@query
def a36_dedup_greedy(spark: SparkSession, sf: str) -> DataFrame:
    """Legacy transcripts, kept when neither statement nor question was seen on a kept row."""
    rows_ = dedup.merge_candidates(_chat(spark, sf))
    known = _current(rows_).select("question_key").where("question_key <> ''")
    kept = dedup.dedup_greedy(_incoming(rows_), "sql_key", "question_key", "row_id", existing=known)
    return kept.select("row_id", "sql_key", "question_key")


@query
def a37_dedup_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_prefix(_raw(spark, sf), 200).select("row_id", "sql")


@query
def a38_append_source(spark: SparkSession, sf: str) -> DataFrame:
    current = _current(_raw(spark, sf)).withColumnRenamed("question", "text")
    return dedup.append_source(current, _new_questions(spark, sf).withColumnRenamed("question", "text"))


# --- sampling and balance --------------------------------------------------------------------


@query
def a39_rebalance(spark: SparkSession, sf: str) -> DataFrame:
    # Written once: the rebalance reads its input three times.
    typed = written(_typed(spark, sf).select("row_id", "sql", "sql_type"), "typed")
    return sampling.rebalance(typed).select("row_id", "sql_type")


@query
def a40_rebalance_report(spark: SparkSession, sf: str) -> DataFrame:
    before = written(_typed(spark, sf).select("row_id", "sql", "sql_type"), "typed")
    return sampling.rebalance_report(before, sampling.rebalance(before))


@query
def a41_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.shuffle(_raw(spark, sf)).select("row_id", sampling.hash_hex("row_id", "shuffle").alias("h"))


@query
def a42_train_val_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.train_val_split(_raw(spark, sf)).select("row_id", "split")


@query
def a42_exact_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.train_val_split(_raw(spark, sf), exact=True).select("row_id", "split")


# --- profiling -------------------------------------------------------------------------------

rows("a43_sql_type", _raw, lambda: {
    "sql_type": statements.sql_type("sql"), "sql_type_permissions": statements.sql_type("sql", permissions=True)})
rows("a44_sql_type_coarse", _raw, lambda: {
    f"{form}_label": statements.sql_type_coarse("sql", form) for form in ("lower", "upper", "plain")})
rows("a45_complexity7", _raw, lambda: {"complexity": statements.complexity7("sql")})
rows("a46_complexity9", _raw, lambda: {"complexity": statements.complexity9("sql")})
rows("a47_sql_features", _raw, lambda: statements.sql_features("sql"))


@query
def a48_pattern_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.pattern_counts(_raw(spark, sf))


@query
def a49_type_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profile.type_distribution(_typed(spark, sf))


@query
def a50_label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profile.label_distribution(_raw(spark, sf), "task_label")


@query
def a51_category_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return profile.category_rollup(_typed(spark, sf))


@query
def a52_balance_verdict(spark: SparkSession, sf: str) -> DataFrame:
    forms = [
        profile.balance_verdict(_typed(spark, sf), form=form).select(F.lit(form).alias("form"), "*")
        for form in ("corpus", "source")
    ]
    return forms[0].unionByName(forms[1])


@query
def a53_feature_rates(spark: SparkSession, sf: str) -> DataFrame:
    return profile.feature_rates(_raw(spark, sf))


@query
def a54_detect_roles(spark: SparkSession, sf: str) -> DataFrame:
    """The roles guessed for each layout, next to the rows that the layout has."""
    out = []
    for df in _layouts(spark, sf):
        roles = profile.detect_roles(df.columns)
        named = [F.lit(c).cast("string").alias(r) for r, c in roles.items()]
        out.append(df.groupBy("source").agg(F.count("*").alias("n")).select("*", *named))
    return corpus.merge_sources(out)


@query
def a55_dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf).select("row_id", "source", "schema_ddl", "question", "sql")
    return profile.dataset_summary(raw, width=60)


@query
def a56_overlap(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    return profile.overlap(_incoming(raw), _current(raw), "question", "question")


@query
def a57_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """Every source against all others."""
    usable = (F.col("schema_ddl") != "") & (F.col("sql") != "")
    return profile.scorecard(profile.source_stats(_raw(spark, sf), "question", usable))


@query
def a58_compare_corpora(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    return profile.compare_corpora({"current": _current(raw), "incoming": _incoming(raw)})


@query
def a78_run_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.run_report(curation.stage(_raw(spark, sf)))


@query
def a78_reject_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.reject_report(curation.stage(_raw(spark, sf)))


@query
def a78_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every row on its way to the curated corpus; the sum over a source is its rows."""
    staged = written(curation.stage(_raw(spark, sf)).select("row_id", "source", "source_rank", "question", "sql", "sql_type", "reject_reason", "text"), "staged")
    unique = written(curation.accepted(staged).select("row_id", "source", "sql", "sql_type"), "unique")
    return profile.ledger(staged, unique, sampling.rebalance(unique), 10, 2048)


@query
def a78_file_report(spark: SparkSession, sf: str) -> DataFrame:
    files = extract.named_like_sql(_files(spark, sf))
    found = written(extract.extract_statements(extract.with_content(files)), "found")
    return profile.file_report(files, found, curation.accepted_statements(found))


# --- quality checks --------------------------------------------------------------------------


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    rows_ = _chat(spark, sf).select(
        "row_id", "text", F.when(F.col("row_id") % 50 != 49, F.col("true_question")).alias("question"),
        chat.assistant_sql("text").alias("answer"), F.col("source").alias("context"),
    )
    return quality.row_checks(rows_)


@query
def a59_row_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf).select("row_id", F.array_join("issues", ",").alias("issues"))


@query
def a60_issue_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.issue_report(_checked(spark, sf))


@query
def a61_readiness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.readiness(_chat(spark, sf))


@query
def a62_dialect_residue(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dialect_residue(_raw(spark, sf))


@query
def a62_residue_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return quality.residue_verdict(quality.dialect_residue(_raw(spark, sf)))


@query
def a63_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    fixed = _raw(spark, sf).select("row_id", "question", statements.mysql_to_postgres("sql").alias("sql"))
    return quality.sample_rows(fixed, F.upper("sql").contains("EXTRACT"), 5)


# --- scoring ---------------------------------------------------------------------------------

_CASE = ("case_id", "model")


def _required() -> Column:
    return F.array(*[F.lit(w) for w in ("select", "FROM", "where", "ORDER BY", "select")])


rows("a64_clean_output", _scored, lambda: {
    "sql": F.col("sql"), "marked": scoring.after_marker("raw_output"), "stopped": scoring.stop_cut("raw_output")}, _CASE)
rows("a65_keyword_coverage", _scored, lambda: {
    "found": F.array_join(scoring.keywords_found("sql", _required()), ","),
    "score": scoring.keyword_coverage("sql", _required())}, _CASE)
rows("a66_looks_like_sql", _scored, lambda: {r: scoring.looks_like_sql("sql", r) for r in scoring.CHATTER}, _CASE)
rows("a67_category_hit", _scored, lambda: {"has_keyword": scoring.category_hit("sql", "category")}, _CASE)


@query
def a68_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return curation.evaluate(derived(spark, sf, "outputs"), list(MODELS))


@query
def a69_version_diff(spark: SparkSession, sf: str) -> DataFrame:
    return score.version_diff(_scored(spark, sf), "step_1000", "step_500")


@query
def a70_pass_rule(spark: SparkSession, sf: str) -> DataFrame:
    scores = curation.coverage_scores(derived(spark, sf, "outputs"), _required())
    return score.pass_rule(scores, "base", "step_1000", F.lit(0.8))


@query
def a71_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    wide = score.side_by_side(derived(spark, sf, "outputs"), "base", ["step_500", "step_1000"])
    shown = F.transform(F.sort_array(F.map_entries("model_outputs")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return wide.select("case_id", "category", "base_output", F.array_join(shown, "|").alias("model_outputs"))


@query
def a71_comparison_table(spark: SparkSession, sf: str) -> DataFrame:
    return score.comparison_table(_scored(spark, sf), list(MODELS))


@query
def a72_delta_summary(spark: SparkSession, sf: str) -> DataFrame:
    return score.delta_summary(_scored(spark, sf), "base", "step_1000")


rows("a73_schema_use", _scored, lambda: scoring.schema_use("sql", "schema_ddl"), _CASE)


@query
def a73_more_complete(spark: SparkSession, sf: str) -> DataFrame:
    wide = score.side_by_side(derived(spark, sf, "outputs"), "base", ["step_1000"])
    return wide.select(
        "case_id", scoring.more_complete(F.col("model_outputs")["step_1000"], "base_output").alias("more_complete")
    )


rows("a74_select_prefix_ok", _scored, lambda: {"verdict": scoring.select_prefix_ok("raw_output")}, _CASE)


def _rules() -> Column:
    """Rules per category: groups that must all hold, each with a choice of needles."""
    n, any_of = scoring.needle, scoring.any_of
    return (
        F.when(F.col("category") == "JOIN", F.array(any_of(n("SELECT")), any_of(n("JOIN"), n("customer_id", "lower"))))
        .when(F.col("category") == "HAVING", F.array(any_of(n("GROUP BY")), any_of(n("HAVING"), n("COUNT"))))
        .otherwise(F.array(any_of(n("SELECT")), any_of(n("orders", "exact"), n("Customer", "exact"))))
    )


rows("a75_expectation_checks", _scored, lambda: {"meets": scoring.meets("sql", _rules())}, _CASE)


@query
def a76_route_prompt(spark: SparkSession, sf: str) -> DataFrame:
    asked = table(spark, sf, "conversations").where(F.col("role") == "user")
    routed = scoring.route_prompt("text")
    priority = F.when(routed, F.lit(scoring.ROUTE_PRIORITY)).otherwise(F.lit(0.0))
    return asked.select("conv_id", "turn", routed.alias("routed"), priority.alias("priority"))


rows("a77_function_allowlist", _raw, lambda: {"disallowed": F.array_join(scoring.disallowed_functions("sql"), ",")})


# --- whole jobs ------------------------------------------------------------------------------


@query
def e1_curated_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return curation.curate(_raw(spark, sf)).select("row_id", "sql_type", "text")


@query
def e2_code_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return curation.code_transcripts(_files(spark, sf))


@query
def e2_merged_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Code-file transcripts appended to the legacy chat rows by the two-key rule."""
    transcripts = written(curation.code_transcripts(_files(spark, sf)), "transcripts")
    numbered = transcripts.select(F.struct("path", "stmt_no").alias("row_id"), "text")
    return curation.merge_code(_chat(spark, sf), numbered, "row_id", cap=None)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of statement in the curated corpus."""
    return profile.type_distribution(curation.curate(_raw(spark, sf), write_between=False))


__all__ = ["QUERIES", "flagship"]
