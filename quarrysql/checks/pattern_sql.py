"""The patterns as plain SQL, for the result check."""


def total(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(12,2))) AS DOUBLE)"


def mean(c: str) -> str:
    return f"({total(c)} / count({c}))"


PATTERN_SQL = {
    "b01_select_alias": "SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance FROM customer",
    "b02_distinct": "SELECT DISTINCT p_brand, p_type FROM part",
    "b03_comparisons": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' AND o_totalprice > 1000 AND o_totalprice <= 400000
          AND o_custkey >= 10 AND o_orderdate < DATE '2001-01-01'""",
    "b04_like": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE 'red _i%'",
    "b05_in_list": """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P', 'O')""",
    "b06_null_tests": """SELECT lang, CAST(count(*) FILTER (WHERE quality IS NULL) AS BIGINT) AS unlabelled,
          CAST(count(*) FILTER (WHERE quality IS NOT NULL) AS BIGINT) AS labelled
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "b07_boolean_mix": """SELECT event_id, event_type, user_id FROM events
        WHERE (event_type = 'purchase' OR event_type = 'signup') AND NOT value < 5 AND user_id > 3""",
    "b08_between": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000",
    "b09_arithmetic": """SELECT l_orderkey, l_linenumber, l_partkey,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net,
          l_extendedprice / l_quantity AS unit_price, l_partkey % 10 AS last_digit,
          l_linenumber + l_suppkey - 1 AS mixed FROM lineitem""",
    "b10_inner_join": """SELECT o_orderkey, c_name, c_mktsegment, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "b11_left_join": f"""SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, {total('o_totalprice')} AS spent
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""",
    "b12_right_join": """SELECT c_custkey, o_custkey, n
        FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) RIGHT JOIN customer
          ON c_custkey = o_custkey""",
    "b13_full_join": """SELECT coalesce(c_nationkey, s_nationkey) AS nationkey, rich_customers, rich_suppliers
        FROM (SELECT c_nationkey, count(*) AS rich_customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1)
        FULL JOIN (SELECT s_nationkey, count(*) AS rich_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
          ON c_nationkey = s_nationkey""",
    "b14_dense_grid": """SELECT c_custkey, status, count(o_orderkey) AS n_orders
        FROM customer CROSS JOIN (VALUES ('F'), ('O'), ('P')) AS s(status)
        LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = status GROUP BY c_custkey, status""",
    "b15_theta_join": """SELECT o_orderkey, l_linenumber, l_partkey, l_extendedprice, o_totalprice
        FROM orders JOIN lineitem
          ON o_orderkey = l_orderkey AND l_shipdate < o_orderdate AND l_extendedprice * 2 > o_totalprice""",
    "b16_three_table_join": f"""SELECT n_name, count(*) AS n_orders, {total('o_totalprice')} AS revenue
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "b16_four_table_join": f"""SELECT c_mktsegment, p_brand, count(*) AS n_lines, {total('l_extendedprice')} AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey GROUP BY c_mktsegment, p_brand""",
    "b17_self_join": """SELECT c.p_partkey AS part, c.p_name AS name, p.p_name AS parent_name
        FROM part c JOIN part p ON c.p_partkey // 2 = p.p_partkey WHERE c.p_partkey > 0""",
    "b18_left_join_is_null": """SELECT c_custkey, c_name FROM customer LEFT JOIN orders
          ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
        WHERE o_orderkey IS NULL""",
    "b19_exists": """SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""",
    "b20_not_exists": """SELECT p_partkey, p_name FROM part
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 40)""",
    "b21_in_subquery": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#17')""",
    "b21_not_in_subquery": """SELECT n_nationkey, n_name FROM nation
        WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)""",
    "b22_aggregates": f"""SELECT count(*) AS n, {total('o_totalprice')} AS total, {mean('o_totalprice')} AS average,
        min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders""",
    "b23_group_by": f"""SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, {total('l_quantity')} AS quantity
        FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber""",
    "b24_having": f"""SELECT o_custkey, count(*) AS n, {total('o_totalprice')} AS spent FROM orders GROUP BY o_custkey
        HAVING count(*) > 10 AND sum(o_totalprice) > 1000000""",
    "b25_count_distinct": """SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days
        FROM orders""",
    "b26_conditional_aggregation": """SELECT user_id,
          CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS n_click,
          CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS n_view,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS n_purchase,
          CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END), 0) AS DOUBLE) AS spent
        FROM events GROUP BY user_id""",
    "b27_duplicates": """SELECT min(doc_id) AS first_doc, count(*) AS copies FROM documents GROUP BY text
        HAVING count(*) > 1""",
    "b27_all_statuses": """SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_custkey
        HAVING count(DISTINCT o_orderstatus) = 2""",
    "b27_exactly_n": "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) = 10",
    "b28_average_of_totals": """SELECT CAST(sum(day_total) AS DOUBLE) / count(*) AS average_day, count(*) AS days
        FROM (SELECT o_orderdate, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS day_total FROM orders GROUP BY 1)""",
    "b29_order_by": """SELECT o_orderkey, o_orderpriority, o_totalprice / 100 AS hundreds FROM orders
        ORDER BY o_orderpriority ASC, hundreds DESC, o_orderkey""",
    "b30_top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "b31_limit_offset": "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id LIMIT 10 OFFSET 20",
    "b32_scalar_subquery": f"""SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_totalprice > (SELECT {mean('o_totalprice')} FROM orders)""",
    "b33_correlated_subquery": f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
        WHERE o_totalprice > (SELECT {mean('i.o_totalprice')} FROM orders i WHERE i.o_custkey = o.o_custkey)""",
    "b34_derived_table": f"""SELECT l_partkey, quantity FROM (SELECT l_partkey, {total('l_quantity')} AS quantity
        FROM lineitem GROUP BY l_partkey) AS d WHERE quantity > 500""",
    "b35_second_highest": """SELECT max(o_totalprice) AS second_highest FROM orders
        WHERE o_totalprice < (SELECT max(o_totalprice) FROM orders)""",
    "b36_single_cte": f"""WITH spent AS (SELECT o_custkey, {total('o_totalprice')} AS total FROM orders GROUP BY o_custkey)
        SELECT c_name, total FROM spent JOIN customer ON c_custkey = o_custkey WHERE total > 2000000""",
    "b36_multiple_ctes": """WITH spent AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
          busy AS (SELECT c_nationkey, n FROM spent JOIN customer ON c_custkey = o_custkey WHERE n > 8)
        SELECT n_name, count(*) AS busy_customers, CAST(sum(n) AS BIGINT) AS n_orders
        FROM busy JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
    "b37_recursive_cte": """WITH RECURSIVE tree(part, depth) AS (
          SELECT p_partkey, 1 FROM part WHERE p_partkey = 1
          UNION ALL
          SELECT p.p_partkey, tree.depth + 1 FROM part p JOIN tree ON p.p_partkey // 2 = tree.part
          WHERE p.p_partkey > 1)
        SELECT part, depth FROM tree""",
    "b38_union": "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
    "b39_union_all": f"""SELECT o_orderpriority, count(*) AS n, {total('o_totalprice')} AS total FROM (
          SELECT * FROM orders WHERE year(o_orderdate) = 1996 UNION ALL
          SELECT * FROM orders WHERE year(o_orderdate) = 1997) GROUP BY o_orderpriority""",
    "b40_intersect": """SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""",
    "b41_except": """SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""",
    "b42_row_number": """SELECT o_orderkey, o_custkey,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""",
    "b43_rank": """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey,
        rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rnk,
        dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS dense_rnk FROM lineitem""",
    "b44_running_total": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (ORDER BY o_orderdate) AS DOUBLE) AS running_total FROM orders""",
    "b44_running_total_per_user": """SELECT event_id, user_id,
        CAST(sum(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS running_total
        FROM events""",
    "b45_top_n_per_group": """SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT *,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
        WHERE rn <= 3""",
    "b46_share_of_group": """SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) * 100
        / CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS pct FROM orders""",
    "b47_case": """SELECT CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle'
        ELSE 'low' END AS band, count(*) AS n FROM orders GROUP BY 1""",
    "b48_nested_case": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN
            CASE WHEN o_totalprice > 200000 THEN CASE WHEN year(o_orderdate) < 1998 THEN 'A1' ELSE 'A2' END ELSE 'B' END
          ELSE 'C' END
        ELSE CASE WHEN o_totalprice > 200000 THEN 'D' ELSE 'E' END END AS label FROM orders""",
    "b49_coalesce": "SELECT doc_id, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)",
    "b50_rounding": """SELECT l_orderkey, l_linenumber, l_partkey,
        CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS rounded,
        CAST(floor(l_extendedprice) AS BIGINT) AS low, CAST(ceil(l_extendedprice) AS BIGINT) AS high FROM lineitem""",
    "b51_text_functions": """SELECT doc_id, upper(lang) AS upper_lang, lower(source) AS lower_source,
        length(text) AS len, length(trim(text)) AS trimmed_len, substr(source, 2, 3) AS part FROM documents""",
    "b52_concat": "SELECT c_custkey, concat(c_name, ' <', c_mktsegment, '>') AS label FROM customer",
    "b53_cast": """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS custkey_text, CAST(o_orderdate AS DATE) AS order_day,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_no FROM orders""",
    "b54_address_domain": """SELECT page_id, split_part(url, '/', 3) AS domain, position('/' IN url) AS first_slash
        FROM pages""",
    "b55_extract": """SELECT o_orderkey, extract(year FROM o_orderdate) AS order_year,
        extract(month FROM o_orderdate) AS order_month, extract(day FROM o_orderdate) AS order_day FROM orders""",
    "b56_date_range": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
        WHERE o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1996-08-31'""",
    "b57_last_days": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
        WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""",
    "b58_month_totals": f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
        {total('o_totalprice')} AS revenue FROM orders GROUP BY 1""",
}
