"""Distributions, rates and verdicts over a corpus.

Counts are aggregated before they move. The windows without a partition see one row per label of a
fixed list; totals over open-ended labels are scalar subqueries instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.functions.statements import category, spaced_patterns, sql_features, sql_type_coarse
from quarrysql.functions.text import as_col, lower_strip
from quarrysql.operators.skew import join_null_safe

# Names looked for when guessing what a column holds.
SQL_EXACT = ("sql", "response", "sql_query")
SQL_NOT = ("complexity", "type", "prompt", "context")
QUESTION_EXACT = ("instruction", "user_prompt")
QUESTION_PARTS = ("question", "prompt", "query")
SCHEMA_PARTS = ("schema", "context", "table")
OVERLAP_PARTS = ("question", "prompt", "query", "text")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def type_distribution(df: DataFrame, kind: str = "sql_type", sql: str = "sql") -> DataFrame:
    """Rows and percent per kind, most common first; rows without SQL are counted apart."""
    counted = df.groupBy(
        F.when(F.coalesce(F.col(sql), F.lit("")) == "", "(no sql)").otherwise(F.col(kind)).alias(kind)
    ).agg(F.count("*").alias("n"))
    is_kind = F.col(kind) != "(no sql)"
    total = F.sum(F.when(is_kind, F.col("n")).otherwise(0)).over(Window.partitionBy())
    pct = F.when(is_kind, _percent(F.col("n"), total))
    return counted.withColumn("pct", pct).orderBy(F.desc(is_kind), F.desc("n"), kind)


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per label; the percent is of all rows, labelled or not."""
    total = df.select(F.count("*")).scalar()
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", _percent(F.col("n"), total)).orderBy(F.desc("n"), label)


def category_rollup(df: DataFrame, kind: str = "sql_type") -> DataFrame:
    """Read, write, DDL, CTE and other."""
    counted = df.groupBy(category(kind).alias("category")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counted.withColumn("pct", _percent(F.col("n"), total))


def balance_verdict(df: DataFrame, kind: str = "sql_type", form: str = "corpus") -> DataFrame:
    """How far SELECT dominates; ``form`` picks the cut-offs 90/70 or 95/80."""
    high, low = (90.0, 70.0) if form == "corpus" else (95.0, 80.0)
    share = _percent(F.sum((F.col(kind) == "SELECT").cast("bigint")), F.count("*"))
    stats = df.agg(F.count("*").alias("n"), share.alias("select_pct"))
    verdict = (
        F.when(F.col("select_pct") > high, "almost only select")
        .when(F.col("select_pct") > low, "mostly select")
        .otherwise("diverse")
    )
    return stats.withColumn("verdict", verdict)


def pattern_counts(df: DataFrame, sql: str = "sql") -> DataFrame:
    """Rows per blank-delimited pattern, with their percent."""
    flags = spaced_patterns(sql)
    sums = [F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(name) for name, c in flags.items()]
    wide = df.agg(F.count("*").alias("total"), *sums)
    long = wide.unpivot(["total"], list(flags), "pattern", "n")
    return long.select("pattern", "n", _percent(F.col("n"), F.col("total")).alias("pct"))


def feature_rates(
    df: DataFrame, sql: str = "sql", question: str = "question", schema: str = "schema_ddl"
) -> DataFrame:
    """Mean of every feature over rows with SQL, mean lengths, share of rows with a schema.

    Looks at all rows; pass :func:`quarrysql.operators.sampling.first_rows` of them for a sample.
    """
    has_sql = F.coalesce(F.col(sql), F.lit("")) != ""
    feats = sql_features(sql)
    means = [F.avg(F.when(has_sql, c.cast("double"))).alias(name) for name, c in feats.items()]
    with_schema = F.sum((has_sql & (F.coalesce(F.col(schema), F.lit("")) != "")).cast("bigint"))
    return df.agg(
        F.count("*").alias("n"),
        *means,
        F.avg(F.when(has_sql, F.length(sql))).alias("avg_sql_length"),
        F.avg(F.when(has_sql, F.length(F.coalesce(F.col(question), F.lit(""))))).alias("avg_question_length"),
        (with_schema / F.count("*")).alias("has_schema"),
    )


def detect_roles(columns: list[str]) -> dict[str, str | None]:
    """Which columns hold the SQL, the question and the schema, first match in column order."""

    def first(test) -> str | None:
        return next((c for c in columns if test(c.lower())), None)

    def holds(parts: tuple[str, ...], name: str) -> bool:
        return any(p in name for p in parts)

    return {
        "sql": first(lambda n: n in SQL_EXACT or ("sql" in n and not holds(SQL_NOT, n))),
        "question": first(
            lambda n: n in QUESTION_EXACT or (holds(QUESTION_PARTS, n) and "sql" not in n) or n == "text"
        ),
        "schema": first(lambda n: n == "input" or holds(SCHEMA_PARTS, n)),
        "overlap_question": first(lambda n: holds(OVERLAP_PARTS, n)),
    }


def dataset_summary(df: DataFrame, order: str = "row_id", width: int = 200) -> DataFrame:
    """Row count, columns, and the values of the first row, cut at ``width`` characters."""
    cols = df.columns

    def shown(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)

    sample = F.min_by(F.struct(*[shown(c).alias(c) for c in cols]), F.col(order))
    one = df.agg(F.count("*").alias("total"), sample.alias("s"))
    entry = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col("s")[c].alias("sample"))
        for i, c in enumerate(cols)
    ]
    return one.select("total", F.inline(F.array(*entry)))


def overlap(new: DataFrame, current: DataFrame, new_question: Column | str, current_question: Column | str) -> DataFrame:
    """Overlapping rows over distinct new questions, in percent, next to the distinct share.

    New rows are counted per question before the join, so a hot question travels once per task.
    """
    keyed = new.select(lower_strip(new_question).alias("q")).where(F.coalesce(F.col("q"), F.lit("")) != "")
    counted = keyed.groupBy("q").agg(F.count("*").alias("n"))
    known = current.select(lower_strip(current_question).alias("q")).distinct().withColumn("known", F.lit(True))
    joined = counted.join(known, "q", "left")
    hit = F.col("known").isNotNull()
    stats = joined.agg(
        F.count("*").alias("new_unique"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("overlapping_rows"),
        F.coalesce(F.sum(hit.cast("bigint")), F.lit(0)).alias("overlapping_unique"),
    )
    return stats.withColumn(
        "overlap_rate", _percent(F.col("overlapping_rows"), F.col("new_unique"))
    ).withColumn("unique_overlap_rate", _percent(F.col("overlapping_unique"), F.col("new_unique")))


def source_stats(df: DataFrame, question: Column | str, usable: Column, source: str = "source") -> DataFrame:
    """For every source its rows (``total``), the percent of ``usable`` ones, and the overlap (A56) with all other sources.

    One pass for any number of sources: rows are counted per question and source, which sources a question has is gathered
    per question, and the rest is counting. A hot question travels once per task and source.
    """
    key = F.coalesce(lower_strip(question), F.lit(""))
    own = df.groupBy(key.alias("q"), F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"), F.count_if(usable).alias("usable"))
    met = own.groupBy("q").agg(F.collect_list(F.struct("source", "n", "usable")).alias("sources"))  # one entry a source
    told = met.select("q", (F.size("sources") > 1).alias("shared"), F.inline("sources"))
    asked = F.col("q") != ""
    sums = told.groupBy("source").agg(
        F.sum("n").alias("total"),
        F.sum("usable").alias("usable"),
        F.count_if(asked).alias("unique"),
        F.coalesce(F.sum(F.when(asked & F.col("shared"), F.col("n"))), F.lit(0)).alias("overlapping"),
    )
    rate = _percent(F.col("overlapping"), F.col("unique")).alias("overlap_rate")
    return sums.select(F.col("source").alias(source), "total", _percent(F.col("usable"), F.col("total")).alias("schema_pct"), rate)


def scorecard(stats: DataFrame) -> DataFrame:
    """Labels and a recommendation from ``total``, ``overlap_rate`` and ``schema_pct``."""
    total, over, schema = F.col("total"), F.col("overlap_rate"), F.col("schema_pct")
    points = (total > 10_000).cast("int") + (over < 20).cast("int") + (schema > 70).cast("int")
    return (
        stats.withColumn("size_label", F.when(total > 50_000, "large").when(total > 10_000, "medium").otherwise("small"))
        .withColumn("overlap_label", F.when(over < 10, "low").when(over < 30, "moderate").otherwise("high"))
        .withColumn("schema_label", F.when(schema > 80, "has schema").when(schema > 50, "partial").otherwise("missing"))
        .withColumn("score", points)
        .withColumn(
            "verdict",
            F.when(F.col("score") >= 2, "recommended").when(F.col("score") == 1, "consider").otherwise("not recommended"),
        )
    )


def compare_corpora(corpora: dict[str, DataFrame], sql: str = "sql") -> DataFrame:
    """Read, write and DDL percent of several corpora side by side, by first word only."""
    tagged = [
        df.select(F.lit(name).alias("corpus"), category(sql_type_coarse(sql, labels="plain")).alias("category"))
        for name, df in corpora.items()
    ]
    counted = reduce(DataFrame.unionByName, tagged).groupBy("corpus", "category").agg(F.count("*").alias("n"))
    # At most five categories per corpus.
    total = F.sum("n").over(Window.partitionBy("corpus"))
    shares = counted.withColumn("pct", _percent(F.col("n"), total))
    wide = shares.groupBy("category").pivot("corpus", list(corpora)).agg(F.first("pct"))
    return wide.select("category", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in corpora])


def run_report(staged: DataFrame, group: str = "source", reason: str = "reject_reason") -> DataFrame:
    """Rows in, refused, kept by the gate, and their share, per source; open-ended sources are fine.

    What becomes of kept rows later on is in :func:`ledger`.
    """
    refused = F.sum(F.col(reason).isNotNull().cast("bigint"))
    return (
        staged.groupBy(group)
        .agg(F.count("*").alias("rows_in"), refused.alias("refused"))
        .withColumn("kept", F.col("rows_in") - F.col("refused"))
        .withColumn("success_pct", _percent(F.col("kept"), F.col("rows_in")))
    )


def ledger(
    staged: DataFrame, unique: DataFrame, final: DataFrame, low: int, high: int, before: list[DataFrame] | None = None
) -> DataFrame:
    """What became of every row, per source: ``source``, ``outcome``, ``n`` and the percent of the source's rows.

    Outcomes are ``refused: <reason>``, ``length``, ``duplicate``, ``no_sql`` and ``rebalanced``, and ``final`` for the rows that are left; their sum
    is the number of rows read. ``staged`` has ``source``, ``reject_reason`` and ``text``; ``unique`` are the rows after
    duplicates went, ``final`` those of the corpus, both with ``source`` and ``sql``. ``before`` holds tables (source, outcome, n) of rows that left
    before staging. Each table is counted once; only counts are joined.
    """
    fits = F.length("text").between(low, high)
    why = F.when(F.col("reject_reason").isNotNull(), F.concat(F.lit("refused: "), F.col("reject_reason"))).when(~F.coalesce(fits, F.lit(False)), "length")
    n = F.count(F.lit(1))
    first = staged.groupBy("source", F.coalesce(why, F.lit("")).alias("outcome")).agg(n.alias("n"))
    empty = F.sum((F.coalesce("sql", F.lit("")) == "").cast("bigint"))
    steps = [
        first.where("outcome = ''").select("source", F.struct("n").alias("passed")),
        unique.groupBy("source").agg(F.struct(n.alias("n"), empty.alias("no_sql")).alias("unique")),
        final.groupBy("source").agg(F.struct(n.alias("n"), empty.alias("no_sql")).alias("final")),
    ]
    counted = steps[0]
    for more in steps[1:]:
        counted = join_null_safe(counted, more, ["source"], "left")
    of = lambda step, name="n": F.coalesce(F.col(step)[name], F.lit(0))
    no_sql = of("unique", "no_sql") - of("final", "no_sql")
    later = {
        "duplicate": of("passed") - of("unique"),
        "no_sql": no_sql,
        "rebalanced": of("unique") - of("final") - no_sql,
        "final": of("final"),
    }
    rest = counted.select("source", F.inline(F.array(*[F.struct(F.lit(k).alias("outcome"), c.alias("n")) for k, c in later.items()])))
    rows = reduce(DataFrame.unionByName, [first.where("outcome <> ''"), rest.where("n > 0"), *(before or [])])
    # A few outcomes per source.
    return rows.withColumn("pct", _percent(F.col("n"), F.sum("n").over(Window.partitionBy("source"))))


def reject_report(staged: DataFrame, group: str = "source", reason: str = "reject_reason") -> DataFrame:
    """Refused rows per source and reason."""
    return staged.where(as_col(reason).isNotNull()).groupBy(group, reason).agg(F.count("*").alias("n"))


def file_report(files: DataFrame, found: DataFrame, accepted: DataFrame, path: str = "path") -> DataFrame:
    """A78, code files: files looked at, files with SQL, accepted statements, share of files with SQL.

    ``found`` is read here and for ``accepted``: hand over a written table, so that files are searched once.
    """
    counts = {
        "files_checked": files.agg(F.count("*").alias("n")),
        "files_with_sql": found.select(path).distinct().agg(F.count("*").alias("n")),
        "valid_statements": accepted.agg(F.count("*").alias("n")),
    }
    tagged = [df.select(F.lit(name).alias("what"), "n") for name, df in counts.items()]
    one = reduce(DataFrame.unionByName, tagged).agg(*[F.sum(F.when(F.col("what") == name, F.col("n"))).alias(name) for name in counts])
    return one.select(*counts, _percent(F.col("files_with_sql"), F.col("files_checked")).alias("success_pct"))
