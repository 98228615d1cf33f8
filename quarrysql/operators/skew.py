"""Joins and group values that stay even when one group holds a large part of the rows.

The groups with most rows, ``HOT_GROUPS`` of them, are handled by broadcast. So any group that goes through an exchange
holds at most one thousandth of the rows, and what is broadcast does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.session import written

HOT_GROUPS = 1_000


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join where null matches null, with the columns of ``left`` and the rest of ``right``."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in on else c) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = left.join(renamed, cond, how)
    return joined if how == "left_anti" else joined.drop(*[f"_r_{c}" for c in on])


def hottest(groups: DataFrame, weight: str) -> DataFrame:
    """The groups with most rows, at most ``HOT_GROUPS``, found without a sort of all groups."""
    return groups.orderBy(F.desc(weight)).limit(HOT_GROUPS)


def with_group_values(df: DataFrame, on: list[str], **values: Column) -> DataFrame:
    """``df`` with aggregates of each row's group: one narrow pass finds the hot groups, two read the rows.

    Rows of hot groups meet their values by broadcast and stay where they are. All others are exchanged once, and the values
    come from a window over the group.
    """
    n = F.count(F.lit(1))
    groups = df.groupBy(*on).agg(n.alias("_weight"), *[v.alias(name) for name, v in values.items()])
    hot = written(hottest(groups, "_weight").drop("_weight"), "hot-groups")  # at most HOT_GROUPS rows
    of_hot = join_null_safe(df, F.broadcast(hot), on)
    cold = join_null_safe(df, F.broadcast(hot.select(*on)), on, "left_anti")
    whole = Window.partitionBy(*on)
    return of_hot.unionByName(cold.select(*df.columns, *[v.over(whole).alias(name) for name, v in values.items()]))


def look_up(rows: DataFrame, groups: DataFrame, on: list[str], weight: str) -> DataFrame:
    """A left join of ``rows`` with ``groups``, one row for each value of ``on`` with the number of its rows as ``weight``.

    Rows of hot groups get their values by broadcast. They still pass the exchange of the others, but with a number of their own
    that matches nothing, so they are dealt out evenly. Null matches null. ``groups`` is read twice.
    """
    values = [c for c in groups.columns if c not in (*on, weight)]
    hot = hottest(groups, weight).select(*on, F.struct(*values).alias("_hot"))
    found = join_null_safe(rows, F.broadcast(hot), on, "left")
    apart = F.when(F.col("_hot").isNotNull(), F.monotonically_increasing_id()).otherwise(-1)
    cold = groups.select(*on, F.lit(-1).cast("long").alias("_apart"), F.struct(*values).alias("_cold"))
    joined = join_null_safe(found.withColumn("_apart", apart), cold, [*on, "_apart"], "left")
    either = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[either[c].alias(c) for c in values])
