"""Analytic query patterns on the star-schema tables.

Each function takes ``t``, a callable from table name to DataFrame, and returns a lazy DataFrame.
Money is summed as decimal, so totals do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrysql.operators.skew import with_group_values
from quarrysql.operators.windows import ranked, running_total

Tables = Callable[[str], DataFrame]


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def total(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double")


def mean(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double") / F.count(money(c))


def day(c: str) -> Column:
    return F.to_date(c)


# --- projection and filter -------------------------------------------------------------------


def b01_select_alias(t: Tables) -> DataFrame:
    return t("customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_acctbal").alias("balance")
    )


def b02_distinct(t: Tables) -> DataFrame:
    return t("part").select("p_brand", "p_type").distinct()


def b03_comparisons(t: Tables) -> DataFrame:
    o = t("orders")
    keep = (
        (o.o_orderstatus == "F") & (o.o_orderpriority != "5-LOW") & (o.o_totalprice > 1000)
        & (o.o_totalprice <= 400000) & (o.o_custkey >= 10) & (o.o_orderdate < "2001-01-01")
    )
    return o.where(keep).select("o_orderkey", "o_custkey", "o_totalprice")


def b04_like(t: Tables) -> DataFrame:
    return t("part").where(F.col("p_name").like("%ring%") | F.col("p_name").like("red _i%")).select("p_partkey", "p_name")


def b05_in_list(t: Tables) -> DataFrame:
    p = t("orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P", "O"))
    return p.select("o_orderkey", "o_orderpriority", "o_orderstatus")


def b06_null_tests(t: Tables) -> DataFrame:
    marked = t("documents").join(t("labels"), "doc_id", "left")
    return marked.groupBy("lang").agg(
        F.sum(F.col("quality").isNull().cast("bigint")).alias("unlabelled"),
        F.sum(F.col("quality").isNotNull().cast("bigint")).alias("labelled"),
    )


def b07_boolean_mix(t: Tables) -> DataFrame:
    e = t("events")
    keep = ((e.event_type == "purchase") | (e.event_type == "signup")) & ~(e.value < 5) & (e.user_id > 3)
    return e.where(keep).select("event_id", "event_type", "user_id")


def b08_between(t: Tables) -> DataFrame:
    return t("orders").where(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


def b09_arithmetic(t: Tables) -> DataFrame:
    line = t("lineitem")
    net = (money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        net.cast("double").alias("net"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_partkey") % 10).alias("last_digit"),
        (F.col("l_linenumber") + F.col("l_suppkey") - 1).alias("mixed"),
    )


# --- joins -----------------------------------------------------------------------------------


def b10_inner_join(t: Tables) -> DataFrame:
    o, c = t("orders"), t("customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice")


def _orders_per_customer(t: Tables) -> DataFrame:
    """Counted before the join: a hot customer travels as one row per task."""
    return t("orders").groupBy("o_custkey").agg(F.count("*").alias("n"), total("o_totalprice").alias("spent"))


def b11_left_join(t: Tables) -> DataFrame:
    c, per = t("customer"), _orders_per_customer(t)
    return c.join(per, c.c_custkey == per.o_custkey, "left").select(
        "c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("n_orders"), "spent"
    )


def b12_right_join(t: Tables) -> DataFrame:
    c, per = t("customer"), _orders_per_customer(t)
    return per.join(c, c.c_custkey == per.o_custkey, "right").select("c_custkey", "o_custkey", "n")


def b13_full_join(t: Tables) -> DataFrame:
    c = t("customer").where(F.col("c_acctbal") > 9000).groupBy("c_nationkey").agg(F.count("*").alias("rich_customers"))
    s = t("supplier").where(F.col("s_acctbal") > 5000).groupBy("s_nationkey").agg(F.count("*").alias("rich_suppliers"))
    return c.join(s, c.c_nationkey == s.s_nationkey, "full").select(
        F.coalesce("c_nationkey", "s_nationkey").alias("nationkey"), "rich_customers", "rich_suppliers"
    )


def b14_dense_grid(t: Tables) -> DataFrame:
    """Every customer with every order status of a fixed list, orders counted, empty cells included.

    The fixed list is exploded per row, so no product of two tables is built.
    """
    statuses = F.explode(F.array(F.lit("F"), F.lit("O"), F.lit("P"))).alias("status")
    grid = t("customer").select("c_custkey", statuses)
    per = t("orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n")
    )
    return grid.join(per, ["c_custkey", "status"], "left").select(
        "c_custkey", "status", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


def b15_theta_join(t: Tables) -> DataFrame:
    """ON with an equality and two inequalities; the equality keeps it an exchange join."""
    o, line = t("orders"), t("lineitem")
    on = (
        (o.o_orderkey == line.l_orderkey)
        & (line.l_shipdate < o.o_orderdate)
        & (line.l_extendedprice * 2 > o.o_totalprice)
    )
    return o.join(line, on).select("o_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "o_totalprice")


def b16_three_table_join(t: Tables) -> DataFrame:
    per, c, n = _orders_per_customer(t), t("customer"), t("nation")
    joined = per.join(c, per.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy("n_name").agg(F.sum("n").alias("n_orders"), total("spent").alias("revenue"))


def b16_four_table_join(t: Tables) -> DataFrame:
    line, o, c, p = t("lineitem"), t("orders"), t("customer"), t("part")
    joined = (
        line.join(o, line.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(p, line.l_partkey == p.p_partkey)
    )
    return joined.groupBy("c_mktsegment", "p_brand").agg(
        F.count("*").alias("n_lines"), total("l_extendedprice").alias("revenue")
    )


def b17_self_join(t: Tables) -> DataFrame:
    """Parts as a hierarchy: part k hangs below part k div 2."""
    child, parent = t("part").alias("c"), t("part").alias("p")
    on = F.expr("c.p_partkey div 2 = p.p_partkey AND c.p_partkey > 0")
    return child.join(parent, on).select(
        F.col("c.p_partkey").alias("part"), F.col("c.p_name").alias("name"), F.col("p.p_name").alias("parent_name")
    )


def b18_left_join_is_null(t: Tables) -> DataFrame:
    urgent = t("orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"))
    c, o = t("customer"), urgent.select("o_custkey").distinct()
    joined = c.join(o, c.c_custkey == o.o_custkey, "left").where(F.col("o_custkey").isNull())
    return joined.select("c_custkey", "c_name")


def b19_exists(t: Tables) -> DataFrame:
    """The inner side holds each key once: a hot customer is combined before the exchange."""
    c, big = t("customer"), t("orders").where(F.col("o_totalprice") > 450000).select("o_custkey").distinct()
    return c.join(big, c.c_custkey == big.o_custkey, "left_semi").select("c_custkey", "c_name")


def b20_not_exists(t: Tables) -> DataFrame:
    p, bulk = t("part"), t("lineitem").where(F.col("l_quantity") >= 40).select("l_partkey").distinct()
    return p.join(bulk, p.p_partkey == bulk.l_partkey, "left_anti").select("p_partkey", "p_name")


def b21_in_subquery(t: Tables) -> DataFrame:
    line, brand = t("lineitem"), t("part").where(F.col("p_brand") == "Brand#17")
    return line.join(brand, line.l_partkey == brand.p_partkey, "left_semi").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key ...)`` with its null rules, as an exchange anti join.

    One null in the subquery empties the result; a null key passes only when the subquery is empty.
    """
    values = other.select(F.col(other_key).alias("_v")).distinct()
    sizes = values.agg(F.count("*").alias("n"), F.count("_v").alias("known"))
    n, known = sizes.select("n").scalar(), sizes.select("known").scalar()
    unmatched = df.join(values, df[key] == values["_v"], "left_anti")
    return unmatched.where((n == 0) | (F.col(key).isNotNull() & (n == known)))


def b21_not_in_subquery(t: Tables) -> DataFrame:
    rich = t("supplier").where(F.col("s_acctbal") > 8000)
    return not_in(t("nation"), "n_nationkey", rich, "s_nationkey").select("n_nationkey", "n_name")


# --- aggregation -----------------------------------------------------------------------------


def b22_aggregates(t: Tables) -> DataFrame:
    return t("orders").agg(
        F.count("*").alias("n"), total("o_totalprice").alias("total"), mean("o_totalprice").alias("average"),
        F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest"),
    )


def b23_group_by(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count("*").alias("n"), total("l_quantity").alias("quantity")
    )


def b24_having(t: Tables) -> DataFrame:
    per = t("orders").groupBy("o_custkey").agg(F.count("*").alias("n"), total("o_totalprice").alias("spent"))
    return per.where((F.col("n") > 10) & (F.col("spent") > 1000000))


def b25_count_distinct(t: Tables) -> DataFrame:
    return t("orders").agg(
        F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderdate").alias("days")
    )


def b26_conditional_aggregation(t: Tables) -> DataFrame:
    def n_of(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0)).alias(f"n_{kind}")

    return t("events").groupBy("user_id").agg(
        n_of("click"), n_of("view"), n_of("purchase"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", money("value"))), F.lit(0)).cast("double").alias("spent"),
    )


def b27_duplicates(t: Tables) -> DataFrame:
    """Texts that occur more than once. Whole texts are hashed in place; only the hash is exchanged."""
    hashed = t("documents").select("doc_id", F.sha2("text", 256).alias("h"))
    copies = hashed.groupBy("h").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))
    return copies.where("copies > 1").select("first_doc", "copies")


def b27_all_statuses(t: Tables) -> DataFrame:
    closed = t("orders").where(F.col("o_orderstatus").isin("F", "O"))
    seen = closed.groupBy("o_custkey").agg(F.countDistinct("o_orderstatus").alias("statuses"))
    return seen.where("statuses = 2").select("o_custkey")


def b27_exactly_n(t: Tables) -> DataFrame:
    return t("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n = 10").select("o_custkey")


def b28_average_of_totals(t: Tables) -> DataFrame:
    daily = t("orders").groupBy("o_orderdate").agg(F.sum(money("o_totalprice")).alias("day_total"))
    return daily.agg((F.sum("day_total").cast("double") / F.count("*")).alias("average_day"), F.count("*").alias("days"))


# --- sort and limit --------------------------------------------------------------------------


def b29_order_by(t: Tables) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 100).alias("hundreds"))
    return o.orderBy(F.asc("o_orderpriority"), F.desc("hundreds"), "o_orderkey")


def b30_top_k(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


def b31_limit_offset(t: Tables) -> DataFrame:
    return t("events").select("event_id", "ts", "user_id").orderBy(F.desc("ts"), "event_id").offset(20).limit(10)


# --- subqueries and CTEs ---------------------------------------------------------------------


def b32_scalar_subquery(t: Tables) -> DataFrame:
    o = t("orders")
    overall = o.agg(mean("o_totalprice").alias("m")).scalar()
    return o.where(F.col("o_totalprice") > overall).select("o_orderkey", "o_totalprice")


def b33_correlated_subquery(t: Tables) -> DataFrame:
    """The inner average per group; rows of hot groups are not exchanged."""
    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    amount = money("o_totalprice")
    own = with_group_values(o, ["o_custkey"], _sum=F.sum(amount), _n=F.count(amount))
    above = F.col("o_totalprice") > F.col("_sum").cast("double") / F.col("_n")
    return own.where(above).drop("_sum", "_n")


def b34_derived_table(t: Tables) -> DataFrame:
    per = t("lineitem").groupBy("l_partkey").agg(total("l_quantity").alias("quantity"))
    return per.where("quantity > 500").select("l_partkey", "quantity")


def b35_second_highest(t: Tables) -> DataFrame:
    o = t("orders")
    top = o.agg(F.max("o_totalprice")).scalar()
    return o.where(F.col("o_totalprice") < top).agg(F.max("o_totalprice").alias("second_highest"))


def b36_single_cte(t: Tables) -> DataFrame:
    return _sql(t, """
        WITH spent AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
                       FROM {orders} GROUP BY o_custkey)
        SELECT c_name, total FROM spent JOIN {customer} ON c_custkey = o_custkey WHERE total > 2000000""",
        "orders", "customer")


def b36_multiple_ctes(t: Tables) -> DataFrame:
    return _sql(t, """
        WITH spent AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey),
             busy AS (SELECT c_nationkey, n FROM spent JOIN {customer} ON c_custkey = o_custkey WHERE n > 8)
        SELECT n_name, count(*) AS busy_customers, CAST(sum(n) AS BIGINT) AS n_orders
        FROM busy JOIN {nation} ON n_nationkey = c_nationkey GROUP BY n_name""",
        "orders", "customer", "nation")


def b37_recursive_cte(t: Tables) -> DataFrame:
    """Depth of every part below part 1. LIMIT ALL lifts the row limit of recursive queries."""
    return _sql(t, """
        WITH RECURSIVE tree (part, depth) AS (
          SELECT p_partkey, 1 FROM {part} WHERE p_partkey = 1
          UNION ALL
          SELECT p.p_partkey, tree.depth + 1 FROM {part} p JOIN tree ON p.p_partkey div 2 = tree.part
          WHERE p.p_partkey > 1)
        SELECT part, depth FROM tree LIMIT ALL""", "part")


def _sql(t: Tables, text: str, *names: str) -> DataFrame:
    frames = {n: t(n) for n in names}
    return next(iter(frames.values())).sparkSession.sql(text, **frames)


# --- set operations --------------------------------------------------------------------------


def b38_union(t: Tables) -> DataFrame:
    c = t("customer").select(F.col("c_nationkey").alias("nationkey"))
    return c.union(t("supplier").select("s_nationkey")).distinct()


def b39_union_all(t: Tables) -> DataFrame:
    o = t("orders")
    d, columns = F.col("o_orderdate"), ("o_orderpriority", "o_totalprice")
    early = o.where((d >= "1996-01-01") & (d < "1997-01-01")).select(*columns)
    late = o.where((d >= "1997-01-01") & (d < "1998-01-01")).select(*columns)
    return early.unionAll(late).groupBy("o_orderpriority").agg(F.count("*").alias("n"), total("o_totalprice").alias("total"))


def _custkeys(t: Tables, status: str) -> DataFrame:
    """Distinct before the set operation, so that no hot key meets itself in a join."""
    return t("orders").where(F.col("o_orderstatus") == status).select("o_custkey").distinct()


def b40_intersect(t: Tables) -> DataFrame:
    return _custkeys(t, "F").intersect(_custkeys(t, "P"))


def b41_except(t: Tables) -> DataFrame:
    return _custkeys(t, "F").subtract(_custkeys(t, "O"))


# --- windows ---------------------------------------------------------------------------------


def b42_row_number(t: Tables) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("o_day"))
    placed = ranked(o, ["o_custkey"], "o_day", tie_break="o_orderkey")
    return placed.select("o_orderkey", "o_custkey", F.col("row_number").cast("bigint").alias("rn"))


def b43_rank(t: Tables) -> DataFrame:
    line = t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("qty"))
    placed = ranked(line, ["l_suppkey"], "qty", descending=True)
    return placed.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
        F.col("rank").cast("bigint").alias("rnk"), F.col("dense_rank").cast("bigint").alias("dense_rnk"),
    )


def b44_running_total(t: Tables) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_totalprice", day("o_orderdate").alias("o_day"))
    running = running_total(o, [], "o_day", money("o_totalprice"))
    return running.select("o_orderkey", "o_day", F.col("running_total").cast("double").alias("running_total"))


def b44_running_total_per_user(t: Tables) -> DataFrame:
    e = t("events").select("event_id", "user_id", "ts", "value")
    running = running_total(e, ["user_id"], "ts", money("value"))
    return running.select("event_id", "user_id", F.col("running_total").cast("double").alias("running_total"))


def b45_top_n_per_group(t: Tables) -> DataFrame:
    """The filter on row_number lets Spark keep three rows per customer and task before the exchange."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    best = t("orders").select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w).alias("rn"))
    return best.where("rn <= 3").withColumn("rn", F.col("rn").cast("bigint"))


def b46_share_of_group(t: Tables) -> DataFrame:
    """Totals of hot groups are combined before the exchange, and their rows stay where they are."""
    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    own = with_group_values(o, ["o_custkey"], group_total=F.sum(money("o_totalprice")))
    share = money("o_totalprice").cast("double") * 100 / F.col("group_total").cast("double")
    return own.select("o_orderkey", "o_custkey", share.alias("pct"))


# --- scalar functions ------------------------------------------------------------------------


def b47_case(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    band = F.when(price > 300000, "high").when(price > 100000, "middle").otherwise("low")
    return t("orders").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


def b48_nested_case(t: Tables) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    large, old = F.col("o_totalprice") > 200000, F.year("o_orderdate") < 1998
    label = F.when(
        F.col("o_orderstatus") == "F",
        F.when(urgent, F.when(large, F.when(old, "A1").otherwise("A2")).otherwise("B")).otherwise("C"),
    ).otherwise(F.when(large, "D").otherwise("E"))
    return t("orders").select("o_orderkey", label.alias("label"))


def b49_coalesce(t: Tables) -> DataFrame:
    marked = t("documents").select("doc_id").join(t("labels"), "doc_id", "left")
    return marked.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


def b50_rounding(t: Tables) -> DataFrame:
    x = money("l_extendedprice")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(x, 1).cast("double").alias("rounded"),
        F.floor("l_extendedprice").cast("bigint").alias("low"),
        F.ceil("l_extendedprice").cast("bigint").alias("high"),
    )


def b51_text_functions(t: Tables) -> DataFrame:
    return t("documents").select(
        "doc_id", F.upper("lang").alias("upper_lang"), F.lower("source").alias("lower_source"),
        F.length("text").cast("bigint").alias("len"), F.length(F.trim("text")).cast("bigint").alias("trimmed_len"),
        F.substr("source", F.lit(2), F.lit(3)).alias("part"),
    )


def b52_concat(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", F.concat("c_name", F.lit(" <"), "c_mktsegment", F.lit(">")).alias("label"))


def b53_cast(t: Tables) -> DataFrame:
    return t("orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("custkey_text"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_no"),
    )


def b54_address_domain(t: Tables) -> DataFrame:
    return t("pages").select(
        "page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("domain"),
        F.expr("position('/' IN url)").cast("bigint").alias("first_slash"),
    )


def b55_extract(t: Tables) -> DataFrame:
    parts = [F.expr(f"extract({p} FROM o_orderdate)").cast("bigint").alias(f"order_{p}") for p in ("year", "month", "day")]
    return t("orders").select("o_orderkey", *parts)


def b56_date_range(t: Tables) -> DataFrame:
    o = t("orders").where(F.col("o_orderdate").between("1996-03-01", "1996-08-31"))
    return o.select("o_orderkey", day("o_orderdate").alias("order_day"))


def b57_last_days(t: Tables) -> DataFrame:
    o = t("orders")
    newest = o.agg(F.max("o_orderdate")).scalar()
    return o.where(F.col("o_orderdate") >= newest - F.expr("INTERVAL '30' DAY")).select("o_orderkey", day("o_orderdate").alias("order_day"))


def b58_month_totals(t: Tables) -> DataFrame:
    month = F.date_trunc("month", "o_orderdate").cast("date").alias("month")
    return t("orders").groupBy(month).agg(F.count("*").alias("n"), total("o_totalprice").alias("revenue"))


PATTERNS = {name: fn for name, fn in list(globals().items()) if name[0] == "b" and name[1:3].isdigit()}
