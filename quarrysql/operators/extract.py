"""SQL statements out of code files."""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrysql.functions.statements import describe_sql, sql_type_coarse
from quarrysql.functions.text import compute_once, strip
from quarrysql.operators.sampling import first_rows
from quarrysql.session import cut_lineage

# Where statements start and stop, and what a table definition looks like.
STATEMENT_HEAD = re.compile(r"(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|WITH)\s+", re.I)
STATEMENT_ENDS = (";", "\n\n")
TABLE_HEAD = re.compile(r"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\w+)\s*\(", re.I)
SQL_EXTENSIONS = ("sql", "sqlite", "db")
SHORTEST = 10

_FOUND = "path string, stmt_no int, schema_ddl string, sql string, table_name string"
_CHUNK = 4_096


def named_like_sql(files: DataFrame) -> DataFrame:
    """Files with an SQL extension, or with ``sql`` in their path."""
    return files.where(F.lower("ext").isin(*SQL_EXTENSIONS) | F.lower("path").contains("sql"))


def with_content(files: DataFrame) -> DataFrame:
    """Trimmed content of at least 20 characters."""
    return compute_once(files, content=strip("content")).where(F.length("content") >= 20)


def select_sql_files(files: DataFrame) -> DataFrame:
    """SQL files by extension or path, with at least 20 characters of content."""
    return with_content(named_like_sql(files))


def tables_in(content: str):
    """Yield ``(end, definition, name)`` for every table, up to its first closing parenthesis.

    The parenthesis is looked up, not matched, so a file of unfinished definitions takes linear time.
    """
    head = TABLE_HEAD.search(content)
    while head:
        close = content.find(")", head.end())
        if close < 0:
            return
        if close > head.end():
            yield close + 1, content[head.start() : close + 1].strip(), head.group(1)
            head = TABLE_HEAD.search(content, close + 1)
        else:  # empty parentheses define nothing
            head = TABLE_HEAD.search(content, head.start() + 1)


def spans_in(content: str):
    """Yield ``(start, end)`` of every statement: up to its first semicolon, which is part of it, or its first empty line.

    The ends are looked up, each place once, instead of being tried at every character.
    """
    semicolon = gap = -1
    head = STATEMENT_HEAD.search(content)
    while head:
        after = head.end()
        if semicolon < after:
            semicolon = content.find(STATEMENT_ENDS[0], after)
            semicolon = len(content) if semicolon < 0 else semicolon
        if gap < after:
            gap = content.find(STATEMENT_ENDS[1], after)
            gap = len(content) if gap < 0 else gap
        end = min(semicolon + 1, gap, len(content))
        yield head.start(), end
        head = STATEMENT_HEAD.search(content, end)


def statements_in(content: str):
    """Yield ``(schema, sql, table)`` for one file: statements first, then one entry per table.

    The schema of a statement is the last table definition that ends before it. One pass finds the
    tables, a binary search places each statement.
    """
    tables = list(tables_in(content))
    ends = [t[0] for t in tables]
    for start, end in spans_in(content):
        sql = content[start:end].strip().rstrip(";").strip()
        if len(sql) < SHORTEST:
            continue
        before = bisect.bisect_right(ends, start)
        yield (tables[before - 1][1] if before else "", sql, None)
    for _, ddl, name in tables:
        yield ddl, ddl, name


def _explode_files(batches):
    out = []
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for number, (schema, sql, table) in enumerate(statements_in(content)):
                out.append((path, number, schema, sql, table))
                if len(out) >= _CHUNK:
                    yield _batch(out)
                    out = []
    if out:
        yield _batch(out)


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["path", "stmt_no", "schema_ddl", "sql", "table_name"])


def extract_statements(files: DataFrame) -> DataFrame:
    """One row per statement with its schema, instruction and kind.

    Python only finds the offsets, which no built-in returns; instruction and kind are native columns.
    """
    found = files.select("path", "content").mapInArrow(_explode_files, _FOUND)
    is_table = F.col("table_name").isNotNull()
    return found.select(
        "path",
        "stmt_no",
        F.when(is_table, F.concat(F.lit("Show the schema for table "), F.col("table_name")))
        .otherwise(describe_sql("sql"))
        .alias("instruction"),
        "schema_ddl",
        "sql",
        F.when(is_table, "schema").otherwise(sql_type_coarse("sql")).alias("type"),
    )


def scan_budget(files: DataFrame, limit: int, max_check: int | None = None, order: str = "file_id") -> DataFrame:
    """The first ``limit`` files with SQL, as long as the budget lasts.

    Files are taken in the order of the numeric id ``order``. The file that uses up ``max_check`` (by
    default 20 per wanted file) is counted but no longer read.
    """
    looked_at = with_content(first_rows(named_like_sql(files), (max_check or 20 * limit) - 1, order))
    # Narrow ids of fewer than max_check files, written once: the extraction runs a single time.
    hits = extract_statements(looked_at.withColumn("path", F.col(order).cast("string"))).select("path").distinct()
    ids = cut_lineage(hits.select(F.col("path").cast(files.schema[order].dataType).alias(order)))
    return with_content(files).join(ids.orderBy(order).limit(limit), order, "left_semi")
