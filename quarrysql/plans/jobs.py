"""The jobs a user runs: sources in, corpus and reports out."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysql.functions import chat, statements
from quarrysql.functions.text import strip
from quarrysql.operators import dedup, encode, extract, profile, sampling, score
from quarrysql.plans import curation
from quarrysql.session import written
from quarrysql.sources import corpus


@dataclass(frozen=True)
class Source:
    """One input: its name, path and layout, and how many of its rows may enter."""

    name: str
    path: str
    layout: str = "context_qa"
    cap: int | None = None


@dataclass(frozen=True)
class Options:
    """What the corpus job does; the defaults are the usual run."""

    dialect: str = "sql"
    form: str = "chat"  # or "simple"
    validate: bool = True
    deduplicate: bool = True
    rebalance: bool = True
    select_ratio: float = 0.77
    min_length: int = 10
    max_length: int = 2048
    encode: bool = False
    sequence_length: int = 1536


def _ingested(spark: SparkSession, sources: list[Source]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows, those within the caps, and the broken lines. Every line is parsed once and written once."""
    parts = []
    for rank, source in enumerate(sources):
        rows = corpus.parse_jsonl(spark, source.path, corpus.LAYOUTS[source.layout])
        tagged = rows.withColumns({"_name": F.lit(source.name), "_rank": F.lit(rank)})
        common = corpus.to_common(tagged, keep=("_name", "_rank", "text", corpus.LINE, corpus.PATH))
        if "text" not in common.columns:
            common = common.withColumn("text", F.lit(None).cast("string"))
        parts.append(common)
    merged = corpus.merge_sources(parts).withColumnsRenamed({"_name": "source", "_rank": "source_rank"})
    fixed = written(merged.withColumn("row_id", F.monotonically_increasing_id()), "ingested")
    broken = fixed.where(F.col(corpus.LINE).isNotNull()).select(
        F.col(corpus.LINE).alias("line"), F.col(corpus.PATH).alias("file_path"), "source"
    )
    good = fixed.where(F.col(corpus.LINE).isNull()).drop(corpus.LINE, corpus.PATH)
    capped = [
        part if source.cap is None else sampling.cap_source(part, source.cap)
        for rank, source in enumerate(sources)
        for part in [good.where(F.col("source_rank") == rank)]
    ]
    return good, corpus.merge_sources(capped), broken


def ingest(spark: SparkSession, sources: list[Source]) -> tuple[DataFrame, DataFrame]:
    """All sources as common rows with fixed ids, and the broken lines.

    Ids follow the order of the sources and of the read. They are written once, because reading again
    may cut the files differently.
    """
    return _ingested(spark, sources)[1:]


def stage_rows(common: DataFrame, options: Options) -> DataFrame:
    """Finished transcripts are rebuilt (A24), all other rows are formatted from their parts.

    Without validation finished transcripts keep their text and no row has a reject reason. ``question_key`` is the whole
    question; of finished transcripts without answer and user turn the whole text, hashed; null where there is no question.
    """
    strict = options.dialect == "postgres"
    columns = ["row_id", "source", "source_rank", "question", "sql", "reject_reason", "text", "question_key"]
    has_text = F.coalesce(F.col("text"), F.lit("")) != ""
    raw = curation.stage(common.where(~has_text).drop("text"), options.dialect, lint=strict)
    if options.form == "simple":
        schema = statements.canonicalize_schema("schema_ddl")
        raw = raw.withColumn("text", chat.render_simple(schema, "question", "sql"))
    made = curation.rebuild_text(common.where(has_text).withColumn("finished", F.col("text")), options.dialect, lint=strict)
    asked = lambda c: F.when(c != "", F.concat(F.lit("="), c))
    raw = raw.withColumn("question_key", asked(F.col("question")))
    turn = chat.user_question("finished", F.lit(""))
    made = made.withColumn("question_key", F.coalesce(asked(turn), F.when(F.col("sql") == "", F.sha2("finished", 256))))
    if not options.validate:
        made = made.withColumn("text", F.col("finished"))
    both = raw.select(*columns).unionByName(made.select(*columns))
    if not options.validate:
        both = both.withColumn("reject_reason", F.lit(None).cast("string"))
    return both.withColumn("sql_type", statements.sql_type(statements.strip_reasoning("sql")))


def _ledger(sources, read, common, broken, staged, unique, final, options: Options) -> DataFrame:
    """The outcome of every line of every source, broken lines and those beyond a cap included."""

    def counted(df: DataFrame, outcome: str) -> DataFrame:
        return df.groupBy("source").agg(F.count("*").alias("n")).select("source", F.lit(outcome).alias("outcome"), "n")

    before = [counted(broken, "broken")]
    if any(s.cap is not None for s in sources):
        rows = counted(read, "capped").unionByName(counted(common, "capped").withColumn("n", -F.col("n")))
        before.append(rows.groupBy("source", "outcome").agg(F.sum("n").alias("n")).where("n > 0"))
    return profile.ledger(staged, unique, final, options.min_length, options.max_length, before)


def build_corpus(spark: SparkSession, sources: list[Source], out: str, options: Options | None = None) -> DataFrame:
    """Reads, stages, gates, deduplicates, balances and writes a corpus; returns its metadata row.

    ``out`` gets ``train`` (text lines) or ``train_tokenized`` (columnar, split, whole texts in numbered windows), ``metadata``,
    ``rejects``, ``quarantine``, and ``ledger``, which says for each source what became of all its lines.
    """
    options = options or Options()
    read, common, broken = _ingested(spark, sources)
    # Read by the reports and by what follows, so it is staged once.
    staged = written(stage_rows(common, options), "staged")
    profile.reject_report(staged).write.mode("errorifexists").json(f"{out}/rejects")
    broken.write.mode("errorifexists").json(f"{out}/quarantine")
    passed = curation.passed(staged, options.min_length, options.max_length)
    # Rows without a question are no duplicates of each other.
    key = F.struct("question_key", F.when(F.col("question_key").isNull(), F.col("row_id")))
    unique = dedup.dedup_first(passed, key) if options.deduplicate else passed
    unique = written(unique.select("row_id", "source", "sql", "sql_type", "text"), "unique")
    final = sampling.rebalance(unique, options.select_ratio) if options.rebalance else unique
    final = written(final, "final")
    _ledger(sources, read, common, broken, staged, unique, final, options).write.mode("errorifexists").json(f"{out}/ledger")
    params = {k: str(v) for k, v in asdict(options).items()}
    if options.encode:
        split = sampling.train_val_split(final, exact=True)
        vocabulary = encode.build_vocabulary(final)
        encoded = encode.encode_fixed(final, vocabulary, "row_id", max_len=options.sequence_length)
        corpus.write_columnar(encoded.join(split.select("row_id", "split"), "row_id"), f"{out}/train_tokenized")
        vocabulary.write.mode("errorifexists").parquet(f"{out}/vocabulary")
        metadata = corpus.corpus_metadata(split, params)
    else:
        corpus.write_text_jsonl(sampling.shuffle(final) if options.rebalance else final, f"{out}/train")
        metadata = corpus.corpus_metadata(final, params, split=None)
    metadata.write.mode("errorifexists").json(f"{out}/metadata")
    return metadata


def append_instructions(current: DataFrame, instructions: DataFrame) -> DataFrame:
    """A35 and A38 for instruction rows: required fields, dialect fix, gate, legacy form, new questions only.

    ``instructions`` has ``row_id``, ``instruction``, ``input`` and ``response``; ``current`` has ``text``.
    """
    whole = corpus.required_fields(instructions)
    fixed = whole.withColumn("sql", statements.sqlite_to_postgres(statements.sanitize_answer("response")))
    good = statements.gate(fixed).where("reject_reason IS NULL")
    made = good.withColumn(
        "text", chat.render_legacy(strip("input"), strip("instruction"), "sql")
    ).withColumn("source_rank", F.lit(0))
    new = dedup.anti_existing(made, current, chat.legacy_question_key("text"), chat.legacy_question_key("text"))
    return dedup.append_source(current, new)


def merge_code_files(spark: SparkSession, files: str, base: str, dialect: str = "sql", cap: int | None = None) -> int:
    """E2 from files to files: statements of code files become transcripts, and those that are new join the corpus at ``base``.

    ``files`` are JSON lines (content, ext, path). The corpus is the latest version below ``base``, which has a column ``text``; the
    first run starts one. Returns the number of the version written, refused with ``corpus.VersionTaken`` if another
    writer was faster. A folder ``reports/version=<n>`` beside it gets the file report and the broken lines.
    """
    version = corpus.latest_version(spark, base)
    rows, broken = corpus.read_jsonl(spark, files, corpus.LAYOUTS["code_file"])
    named = extract.named_like_sql(rows)
    found = written(extract.extract_statements(extract.with_content(named)), "found")
    good = written(curation.accepted_statements(found), "accepted")
    made = good.select(F.struct("path", "stmt_no").alias("row_id"), chat.render_legacy("schema_ddl", "instruction", "sql", dialect).alias("text"))
    empty = spark.createDataFrame([], "text string")
    current = corpus.snapshot_read(spark, base, version).select("text") if version else empty
    merged = curation.merge_code(current, made, "row_id", cap)
    # The order of the parts is that of the rows; within a part it does not matter.
    number = corpus.snapshot_write(merged.select("text"), base, after=version or 0)
    report = f"{base}/reports/version={number}"
    profile.file_report(named, found, good).write.mode("errorifexists").json(f"{report}/files")
    broken.write.mode("errorifexists").json(f"{report}/quarantine")
    return number


def score_outputs(spark: SparkSession, outputs: str, out: str, models: list[str], rule: str = "checkpoints") -> None:
    """E3 from files to files: raw outputs of models to a leaderboard, a comparison, and what changed between versions.

    ``outputs`` are JSON lines (case_id, category, model, raw_output), ``models`` the versions from the oldest to the newest. ``out`` gets
    ``leaderboard``, ``comparison``, ``changes`` (of each model against the one before it), and ``quarantine``.
    """
    rows, broken = corpus.read_jsonl(spark, outputs, corpus.LAYOUTS["output"])
    judged = written(score.evaluated(rows, rule), "judged")
    reports = {
        "leaderboard": score.leaderboard(judged, models),
        "comparison": score.comparison_table(judged, models),
        "quarantine": broken,
    }
    changes = [
        score.version_diff(judged, new, old).select(F.lit(old).alias("before"), F.lit(new).alias("after"), "*") for old, new in zip(models, models[1:])
    ]
    if changes:
        reports["changes"] = corpus.merge_sources(changes)
    for name, df in reports.items():
        df.write.mode("errorifexists").json(f"{out}/{name}")
