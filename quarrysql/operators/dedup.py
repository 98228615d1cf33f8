"""First-wins duplicate removal and merging against an existing corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.functions.chat import (
    assistant_sql_strict,
    has_all_legacy_tags,
    legacy_question_key,
)
from quarrysql.functions.statements import LIST_SHOWN, describe_sql, gate
from quarrysql.functions.text import as_col, compute_once, lower_strip, strip, unicode_pattern
from quarrysql.operators.components import components
from quarrysql.operators.skew import look_up
from quarrysql.session import written

ORDER = ("source_rank", "row_id")


def dedup_first(df: DataFrame, key: Column | str, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` lets Spark put a group limit below the exchange, so each map task ships at
    most one row of a key, however hot the key is.
    """
    first = Window.partitionBy(as_col(key)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def dedup_prefix(df: DataFrame, width: int, sql: str = "sql", order: tuple[str, ...] = ORDER) -> DataFrame:
    """First row per leading ``width`` characters; statements that differ only later are dropped."""
    return dedup_first(df, F.substring(sql, 1, width), order)


def anti_existing(
    new: DataFrame,
    current: DataFrame,
    new_key: Column | str,
    current_key: Column | str,
    order: tuple[str, ...] = ORDER,
) -> DataFrame:
    """New rows whose key is not in ``current``, first one per key; rows without a key are dropped.

    The first-wins step comes first, so both sides of the anti join hold a key once, and the join
    reuses the partitioning of the window.
    """
    keyed = new.withColumn("_key", as_col(new_key)).where(F.col("_key").isNotNull())
    unique = dedup_first(keyed, "_key", order)
    known = current.select(as_col(current_key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return unique.join(known, "_key", "left_anti").drop("_key")


#: Rounds before the chains that are left are settled by components, and the largest component that one step takes.
ROUNDS, SETTLED = 4, 100_000


def _settle(rows: DataFrame) -> DataFrame:
    """The sequential scan of each component of ``rows`` (root, ord, k1, k2); components follow each other in a task."""
    kind = rows.schema["ord"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        root, seen = None, (set(), set())
        for batch in batches:
            kept = []
            for own, a, b in zip(*[batch.column(c).to_pylist() for c in ("root", "k1", "k2")], strict=True):
                if own != root:
                    root, seen = own, (set(), set())
                kept.append(a not in seen[0] and b not in seen[1])
                if kept[-1]:
                    seen[0].add(a)
                    seen[1].add(b)
            yield batch.select(["ord"]).filter(pa.array(kept, pa.bool_()))

    return rows.select("root", "ord", "k1", "k2").repartition("root").sortWithinPartitions("root", "ord").mapInArrow(run, f"ord {kind}")


def _placed(rows: DataFrame, settled: int) -> DataFrame:
    """``rows`` with ``root``, their component; at most ``settled`` rows in all need no search and count as one."""
    if rows.limit(settled + 1).count() <= settled:
        return rows.withColumn("root", F.lit(0).cast("long"))
    node = {k: F.xxhash64(F.lit(k), k) for k in ("k1", "k2")}  # keys that share a hash only make a component larger
    roots = components(rows.select(node["k1"].alias("a"), node["k2"].alias("b")))
    named = rows.withColumn("node", node["k1"])
    sizes = named.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(roots, "node", "left")
    placed = look_up(named, sizes.withColumn("root", F.coalesce("root", "node")), ["node"], "n")
    return placed.select("root", "ord", "k1", "k2")


def greedy_ids(keys: DataFrame, rounds: int = ROUNDS, settled: int = SETTLED) -> DataFrame:
    """Order values of the rows a sequential two-key scan would keep.

    ``keys`` holds ``ord`` (unique), ``k1`` and ``k2``; null is a key like any other. A row is kept when neither of its keys was seen
    on a kept row before. Each round keeps the rows that come first in both of their groups, then drops
    every row that shares a key with them; the globally first open row is always kept, so the rounds
    end, at the same rows for any size. Rows of keys with many rows leave by broadcast and are never gathered in a task.

    Rows that share first and second keys in turn form a chain, of which a round takes two rows. So after ``rounds`` rounds the rows
    that are left are split into connected components, unless they are few: those of at most ``settled`` rows are scanned in one step,
    each in one task, and the rounds go on for larger ones alone. Every round is written out, so lost executors replay one round at most.
    """
    named = lambda k: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")).alias(k)
    # A later copy of the same pair can never be kept.
    open_rows = written(dedup_first(keys.select("ord", named("k1"), named("k2")), F.struct("k1", "k2"), ("ord",)), "open")
    result, done = open_rows.select("ord").limit(0), 0
    while not open_rows.isEmpty():
        if done == rounds:
            placed = written(_placed(open_rows, settled), "placed")
            members = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
            marked = look_up(placed, members.withColumn("small", F.col("n") <= settled), ["root"], "n")
            result = result.unionByName(written(_settle(marked.where("small")), "settled"))
            open_rows = written(marked.where("NOT small").select("ord", "k1", "k2"), "open")
            done, rounds = 0, rounds * 2
            continue
        groups = {k: open_rows.groupBy(k).agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n")) for k in ("k1", "k2")}
        groups = {k: written(own, "groups") for k, own in groups.items()}
        kept = written(groups["k1"].select("ord").join(groups["k2"].select("ord"), "ord"), "kept")
        result = result.unionByName(kept)
        for k, own in groups.items():
            gone = own.join(kept.withColumn("gone", F.lit(True)), "ord", "left").select(k, "n", "gone")
            open_rows = look_up(open_rows, gone, [k], "n").where("gone IS NULL").drop("gone")
        open_rows = written(open_rows, "open")
        done += 1
    return result


def _without_known(keyed: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known``; rows without a key stay. A hot key is met by broadcast."""
    counts = keyed.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    seen = known.select(key).where(F.col(key).isNotNull()).distinct().withColumn("known", F.lit(True))
    named = keyed.where(F.col(key).isNotNull())
    new = look_up(named, counts.join(seen, key, "left"), [key], "n").where("known IS NULL").drop("known")
    return new.unionByName(keyed.where(F.col(key).isNull()))


def dedup_greedy(
    df: DataFrame,
    sql_key: Column | str,
    question_key: Column | str,
    order: str = "row_id",
    existing: DataFrame | None = None,
) -> DataFrame:
    """Keep a row unless its SQL or its question was seen on a kept row.

    ``order`` is a unique sortable column. ``existing`` holds one column of question keys that count as
    seen. Only hashes of the keys travel through the rounds.
    """
    keyed = df.select(
        F.col(order).alias("ord"),
        F.md5(as_col(sql_key)).alias("k1"),
        F.md5(as_col(question_key)).alias("k2"),
    )
    if existing is not None:
        keyed = _without_known(keyed, existing.select(F.md5(F.col(existing.columns[0])).alias("k2")), "k2")
    kept = greedy_ids(keyed).withColumnRenamed("ord", order)
    return df.join(kept, order, "left_semi")


def normalized_sql(sql: Column | str) -> Column:
    """Lower case, trimmed, every run of white space a single blank."""
    return F.regexp_replace(strip(F.lower(as_col(sql))), unicode_pattern(r"\s+"), " ")


def whole_question_key(asked: Column | str, sql: Column | str) -> Column:
    """The key ``asked`` of a question, not null; one that was made from its statement (A18) counts with the whole select list.

    The wording shows a part of the list, so two statements that differ behind it would look like one question. Only a key with
    a list longer than what is shown can be one: for others nothing is looked up in the statement.
    """
    asked = as_col(asked)
    made = lower_strip(describe_sql(sql))
    cut = asked.startswith("get ") & (F.length(asked) > LIST_SHOWN) & (asked == made)
    return F.when(cut, lower_strip(describe_sql(sql, None))).otherwise(asked)


def question_keys(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the answer ``sql`` and ``question_key`` of legacy transcripts, empty where there is none; each is computed once a row."""
    asked = F.coalesce(legacy_question_key(text), F.lit(""))
    staged = compute_once(df, sql=assistant_sql_strict(text), _asked=asked)
    return compute_once(staged, question_key=whole_question_key("_asked", "sql")).drop("_asked")


def merge_candidates(df: DataFrame, text: str = "text", lint: bool = True) -> DataFrame:
    """Complete legacy transcripts with a statement that passes the gate, keys attached (A36 input)."""
    complete = df.where(has_all_legacy_tags(text))
    staged = question_keys(complete, text).where("sql <> ''")
    if lint:
        staged = gate(staged).where("reject_reason IS NULL").drop("reject_reason")
    return compute_once(staged, sql_key=normalized_sql("sql"))


def append_source(current: DataFrame, new: DataFrame, text: str = "text") -> DataFrame:
    """Current rows first, then the new ones, text only; ``part`` keeps that order."""
    return current.select(F.lit(0).alias("part"), text).unionByName(new.select(F.lit(1).alias("part"), text))
