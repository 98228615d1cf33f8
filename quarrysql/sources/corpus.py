"""Reading source layouts and writing corpora."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrysql.functions.text import as_col, compute_once, first_filled, strip
from quarrysql.session import written


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The columns of each source layout.
LAYOUTS: dict[str, T.StructType] = {
    "context_qa": _strings("context", "question", "answer"),
    "prompt_sql": T.StructType(
        [
            T.StructField("id", T.LongType()),
            *_strings(
                "domain", "domain_description", "sql_complexity", "sql_complexity_description", "sql_task_type",
                "sql_task_type_description", "sql_prompt", "sql_context", "sql", "sql_explanation",
            ).fields,
        ]
    ),
    "instruction": _strings("instruction", "input", "response", "source", "text"),
    "parameters": T.StructType(
        [
            T.StructField("source_file", T.StringType()),
            T.StructField("record_index", T.IntegerType()),
            *_strings("user_prompt", "reasoning", "parameters", "sql_query").fields,
        ]
    ),
    "question_query": _strings("question", "query"),
    "text": _strings("text"),
    "code_file": _strings("content", "ext", "path"),
    "output": _strings("case_id", "category", "model", "raw_output"),
}

# Which columns hold the schema, the question and the SQL, best first.
SCHEMA_KEYS = ("context", "sql_context", "input")
QUESTION_KEYS = ("question", "sql_prompt", "instruction", "user_prompt")
SQL_KEYS = ("answer", "sql", "response", "sql_query", "query")

CORRUPT = "_corrupt_record"


LINE, PATH = "_line", "_path"


def parse_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The rows of JSON lines, each parsed once; a broken line has its text in ``_line``, its file in ``_path``, and no values.

    Blank lines vanish. Nothing is written or cached.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path")).where(strip("value") != "")
    parsed = compute_once(lines, row=F.from_json("value", with_bad, options))
    broken = F.col(f"row.{CORRUPT}").isNotNull()
    values = [F.when(~broken, F.col(f"row.{n}")).alias(n) for n in schema.fieldNames()]
    return parsed.select(*values, F.when(broken, F.col("value")).alias(LINE), F.when(broken, F.col("file_path")).alias(PATH))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the broken ones as (line, file_path), of a table that holds both."""
    good = parsed.where(F.col(LINE).isNull()).drop(LINE, PATH)
    return good, parsed.where(F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"), F.col(PATH).alias("file_path"))


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``. Lines are parsed once, into a table in the shared folder that both parts read."""
    return split_parsed(written(parse_jsonl(spark, path, schema), "parsed"))


def to_common(df: DataFrame, keep: tuple[str, ...] = ("source", "source_rank", "row_id", "text")) -> DataFrame:
    """Schema, question and SQL from whichever layout columns are there, first non-empty wins."""
    have = set(df.columns)

    def pick(keys: tuple[str, ...]):
        return first_filled(*[k for k in keys if k in have])

    return df.select(
        *[c for c in keep if c in have],
        pick(SCHEMA_KEYS).alias("schema_ddl"),
        pick(QUESTION_KEYS).alias("question"),
        pick(SQL_KEYS).alias("sql"),
    )


def merge_sources(parts: list[DataFrame]) -> DataFrame:
    """All sources under each other, in rank order by ``source_rank``; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def required_fields(df: DataFrame, fields: tuple[str, ...] = ("instruction", "response", "input")) -> DataFrame:
    """Rows whose fields are all non-blank after trimming."""
    for name in fields:
        df = df.where(F.coalesce(strip(name), F.lit("")) != "")
    return df


def write_text_jsonl(df: DataFrame, path: str, text: str = "text") -> None:
    """One JSON object per line with the single key ``text``; other characters than ASCII stay."""
    df.select(F.coalesce(as_col(text), F.lit("")).alias("text")).write.mode("errorifexists").json(path)


def write_columnar(df: DataFrame, path: str) -> None:
    """The split corpus as a columnar dataset, one folder per split."""
    df.write.mode("errorifexists").partitionBy("split").parquet(path)


def corpus_metadata(df: DataFrame, params: dict[str, str], text: str = "text", split: str | None = "split") -> DataFrame:
    """One row that describes the corpus: parameters, counts and size."""
    counts = [F.count("*").alias("num_examples"), F.sum(F.length(text)).alias("text_chars")]
    if split is not None:
        for name in ("train", "validation"):
            n = F.sum((F.col(split) == name).cast("bigint"))
            counts.append(F.coalesce(n, F.lit(0)).alias(f"{name}_examples"))
    given = F.struct(*[F.lit(v).alias(k) for k, v in params.items()])
    return df.agg(*counts).select(given.alias("preprocessing"), "*")


class VersionTaken(RuntimeError):
    """Another writer has committed the version."""


def _commits(spark: SparkSession, base: str):
    """The folder of commits: its file system and its path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{base}/commits")
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder, hadoop.Path


def snapshot_write(df: DataFrame, base: str, after: int | None = None) -> int:
    """A10: writes ``df`` below ``base`` as the version after ``after`` (the latest one, if not given), and returns its number.

    The data goes to a folder of its own, which no other write shares. Then the commit of the version, one file that names
    the folder, is made; the file system makes it only if it is not there, so of two writers of one version one
    is refused, with ``VersionTaken``, and what the other has written stays as it is. A job that dies before its
    commit leaves the latest version as it was, and a job may read the version it replaces.
    """
    spark = df.sparkSession
    version = ((latest_version(spark, base) or 0) if after is None else after) + 1
    folder = f"data/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{base}/{folder}")
    line = json.dumps({"version": version, "folder": folder})
    fs, commits, path = _commits(spark, base)
    fs.mkdirs(commits)
    name = path(commits, f"{version:010d}.json")
    try:
        out = fs.create(name, False)
    except Py4JJavaError as error:
        if not fs.exists(name):
            raise
        raise VersionTaken(f"version {version} below {base} is committed already") from error
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()
    return version


def _committed(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the commits below ``base``, one short name each."""
    fs, commits, _ = _commits(spark, base)
    if not fs.exists(commits):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(commits)]
    return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))


def latest_version(spark: SparkSession, base: str) -> int | None:
    return max(_committed(spark, base), default=None)


def snapshot_read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The given version, or the latest committed one."""
    number = version or latest_version(spark, base)
    if number is None or number not in _committed(spark, base):
        raise FileNotFoundError(f"no committed version {number or ''} below {base}")
    commit = spark.read.schema("version long, folder string").json(f"{base}/commits/{number:010d}.json").first()
    return spark.read.parquet(f"{base}/{commit.folder}")
