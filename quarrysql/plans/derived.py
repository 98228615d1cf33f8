"""Corpora made from the star-schema tables by plain SQL.

The given tables hold no SQL text, so the corpus operators run on rows made from them: one row per
order or order line, so the work grows with the tables. The same SQL text runs on Spark and on the
engine that checks the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysql.functions.text import compute_once

_K = "CAST(o_orderkey AS STRING)"
_C = "CAST(o_custkey AS STRING)"
_P = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
_D = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_NL = "chr(10)"

# Twenty statement shapes, one per remainder of the order key.
_SHAPES = [
    f"'SELECT * FROM orders WHERE order_id = ' || {_K}",
    f"'SELECT c.name, o.total FROM customers c JOIN orders o ON c.id = o.customer_id WHERE o.id = ' || {_K}",
    f"'SELECT status, COUNT(*) FROM orders WHERE total > ' || {_P} || ' GROUP BY status'",
    f"'SELECT customer_id, SUM(total) FROM orders GROUP BY customer_id HAVING SUM(total) > ' || {_P}",
    f"'SELECT id, ROW_NUMBER() OVER (PARTITION BY status ORDER BY total) FROM orders WHERE customer_id = ' || {_C}",
    f"'SELECT name FROM customers WHERE id IN (SELECT customer_id FROM orders WHERE total > ' || {_P} || ')'",
    f"'SELECT id FROM orders_2023 WHERE total > ' || {_P} || ' UNION SELECT id FROM orders_2024'",
    f"'  SELECT id, total FROM orders WHERE status = ''' || o_orderstatus || ''' ORDER BY total DESC LIMIT 10 '",
    f"'SELECT id, CASE WHEN total > ' || {_P} || ' THEN ''high'' ELSE ''low'' END AS band FROM orders'",
    f"'SELECT YEAR(order_date), COUNT(*) FROM orders WHERE id > ' || {_K} || ' GROUP BY year( order_date )'",
    f"'SELECT id FROM orders WHERE MONTH(order_date) = 5 AND DAY(order_date) = 1 AND customer_id = ' || {_C}",
    f"'SELECT id FROM orders WHERE order_date >= DATE_SUB(''' || {_D} || ''', INTERVAL 30 DAY)'",
    f"'SELECT id FROM orders WHERE due < CURDATE() AND id = ' || {_K} || ' AND due > date_add(made, interval 2 week)'",
    f"'INSERT INTO orders (id, customer_id, total) VALUES (' || {_K} || ', ' || {_C} || ', ' || {_P} || ');'",
    f"'UPDATE orders SET status = \"' || o_orderstatus || '\" WHERE id = ' || {_K}",
    f"'-- tidy up' || {_NL} || 'DELETE FROM orders WHERE id = ' || {_K}",
    f"'CREATE TABLE orders_' || {_K} || ' (id INTEGER, total DECIMAL)'",
    f"'WITH big AS (SELECT id FROM orders WHERE total > ' || {_P} || ') SELECT COUNT(*) FROM big'",
    "'MATCH (n:Customer) RETURN n.name'",
    "''",
]

_CATEGORY = {
    1: "JOIN", 2: "GROUP BY", 3: "HAVING", 4: "OVER", 5: "IN", 6: "UNION", 7: "ORDER BY", 8: "CASE", 9: "YEAR",
    13: "INSERT", 14: "UPDATE", 15: "DELETE", 16: "CREATE", 17: "WITH",
}


def _case(column: str, branches: dict[int, str], otherwise: str) -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in branches.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


_DDL = (
    "'CREATE TABLE customers (id INTEGER,  name VARCHAR)' || chr(10) || '  ' || chr(10) || "
    "'create table orders (id INTEGER, FOREIGN   KEY (customer_id)   REFERENCES customers (id))' || chr(9)"
)

CORPUS_RAW = f"""
SELECT o_orderkey AS row_id,
       CASE o_orderstatus WHEN 'F' THEN 'synthetic' WHEN 'O' THEN 'community' ELSE 'fixes' END AS source,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS source_rank,
       CASE WHEN o_orderkey % 20 = 3 THEN '' ELSE {_DDL} END AS schema_ddl,
       ' Show result ' || CAST(o_orderkey % 20 AS STRING) || ' for '
         || CASE WHEN o_orderkey % 7 = 0 THEN 'Customer ' || {_C} ELSE 'order ' || {_K} END AS question,
       {_case("o_orderkey % 20", dict(enumerate(_SHAPES)), "''")} AS sql,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS task_label,
       {_case("o_orderkey % 20", {k: f"'{v}'" for k, v in _CATEGORY.items()}, "'SELECT'")} AS category,
       o_orderstatus
FROM orders
"""

_SYSTEM = f"'Dialect: sql' || {_NL} || 'Schema:' || {_NL} || schema_ddl"
_THINK = f"CASE WHEN row_id % 5 = 0 THEN '<think>' || {_NL} || 'Look it up.' || {_NL} || '</think>' || {_NL} ELSE '' END"

# Ten layouts of the transcript, one per last digit: tagged, legacy, legacy without line breaks, open tail.
_TAGGED = (
    f"'<|im_start|>system' || {_NL} || {_SYSTEM} || '<|im_end|>' || {_NL} || '<|im_start|>user' || {_NL} || question"
    f" || '<|im_end|>' || {_NL} || '<|im_start|>assistant' || {_NL} || {_THINK} || sql || '<|im_end|>' || {_NL}"
)
_LEGACY = (
    f"'<|system|>' || {_NL} || {_SYSTEM} || {_NL} || '<|end|>' || {_NL} || '<|user|>' || {_NL} || question || {_NL}"
    f" || '<|end|>' || {_NL} || '<|assistant|>' || {_NL} || sql || {_NL} || '<|end|>'"
)
_TIGHT = f"'<|system|>' || {_SYSTEM} || '<|end|><|user|>' || question || '<|end|><|assistant|>' || sql || '<|end|>'"
_OPEN = f"'<|user|>' || question || '<|end|>' || {_NL} || '<|assistant|>' || sql"

CHAT = f"""
SELECT row_id, source, source_rank, o_orderstatus, question AS true_question,
       CASE WHEN row_id % 2 = 0 THEN {_TAGGED}
            WHEN row_id % 10 = 3 THEN {_TIGHT}
            WHEN row_id % 10 = 9 THEN {_OPEN}
            ELSE {_LEGACY} END AS text
FROM corpus_raw
"""

MODELS = ("base", "step_500", "step_1000")

OUTPUTS = f"""
SELECT row_id AS case_id, category, question, schema_ddl, model,
       CASE (row_id + length(model)) % 4
         WHEN 0 THEN sql || '; SELECT 1'
         WHEN 1 THEN '<think>' || {_NL} || '</think>' || {_NL} || sql
         WHEN 2 THEN 'Let me explain: ' || sql
         ELSE 'Question' || {_NL} || '### SQL:' || {_NL} || sql || {_NL} || {_NL} || '### Notes' END AS raw_output
FROM (SELECT *, 'base' AS model FROM corpus_raw
      UNION ALL SELECT *, 'step_500' AS model FROM corpus_raw
      UNION ALL SELECT *, 'step_1000' AS model FROM corpus_raw) AS m
"""

# Five kinds of file, one per remainder: a script, code with a statement inside, notes, a stub, a schema.
_FILE_BODIES = {
    0: f"'CREATE TABLE items_' || {_K} || ' (part_id INTEGER, qty DECIMAL);' || {_NL} || 'INSERT INTO items_' || {_K}"
    f" || ' VALUES (' || {_C} || ', ' || {_P} || ');' || {_NL} || 'SELECT part_id FROM items_' || {_K}"
    f" || ' WHERE qty > ' || {_P} || {_NL} || {_NL} || 'DROP TABLE items_old;' || {_NL}",
    1: f"'# loader' || {_NL} || 'run(\"update items set qty = ' || {_P} || ' WHERE id = ' || {_K} || '\")' || {_NL}"
    f" || {_NL} || 'print(1)'",
    2: f"'Notes about order ' || {_K} || ', nothing to run here.'",
    3: f"'  SELECT 1' || {_NL}",
}
_FILE_SCHEMA = (
    f"'CREATE TABLE IF NOT EXISTS a_' || {_K} || ' (id INT);' || {_NL} || 'create table b_' || {_C} || ' (id INT)'"
    f" || {_NL} || {_NL} || 'DELETE FROM a_' || {_K} || ' WHERE id = ' || {_C} || ';' || {_NL} || 'ALTER TABLE b ADD c INT'"
)
CODE_FILES = f"""
SELECT o_orderkey AS file_id,
       {_case("o_orderkey % 5", _FILE_BODIES, _FILE_SCHEMA)} AS content,
       CASE o_orderkey % 4 WHEN 0 THEN 'src/' || {_K} || '.SQL' WHEN 1 THEN 'app/' || {_K} || '.py'
                           WHEN 2 THEN 'db/' || {_K} || '.db' ELSE 'sqlscripts/' || {_K} || '.txt' END AS path,
       CASE o_orderkey % 4 WHEN 0 THEN 'SQL' WHEN 1 THEN 'py' WHEN 2 THEN 'db' ELSE 'txt' END AS ext
FROM orders
"""

# Statements on which a gate may err, with the verdict that a reader gives; <K> stands for the key of the order.
GATE_CASES: list[tuple[str, str | None]] = [
    ("SELECT id FROM t WHERE note = '--' AND id = <K>", None),
    ("SELECT 'http://x--y', <K>", None),
    (r"SELECT E'it\'s', <K>", None),
    ("WITH a AS MATERIALIZED (SELECT <K>) SELECT * FROM a", None),
    ("WITH a AS NOT MATERIALIZED (VALUES (<K>)) TABLE a", None),
    ('WITH "a b" AS (SELECT <K> AS x) SELECT x FROM "a b"', None),
    ("WITH RECURSIVE a (x, y) AS (SELECT 1, <K>) SELECT x FROM a", None),
    ("MERGE INTO t USING s ON t.id = s.id WHEN MATCHED THEN UPDATE SET v = <K>", None),
    ("MERGE (n:A {id: <K>}) RETURN n", "non_sql"),
    ("DESCRIBE t_<K>", None),
    ("DESCRIBE <http://x/<K>>", "non_sql"),
    ("INSERT INTO t VALUES (:a, :b, <K>)", None),
    ("EXPLAIN SELECT <K>", None),
    ("VALUES (1), (<K>)", None),
    ("SELECT $$a;b$$, <K>", None),
    ("SELECT $q$it's (open;$q$, <K>", None),
    ('SELECT "it\'s", <K>', None),
    ("/* it's (a; */ SELECT <K>", None),
    ("SELECT <K> -- don't ( stop;", None),
    ("SELECT <K>; -- done", None),
    ("SELECT <K> /* open", "open_comment"),
    ("SELECT '<K>", "open_quote"),
    ("SELECT 'a' || '<K>''", "open_quote"),
    ("SELECT <K>; SELECT 2", "many_statements"),
    ("SELECT (<K> || ')'", "open_parenthesis"),
    ("(SELECT <K>) UNION (SELECT 2)", None),
    ("SELECT x::int FROM t WHERE k = '(n:A)' AND id = <K>", None),
    ("CALL refresh_order(<K>)", None),
    ("CALL db.labels() YIELD label RETURN label, <K>", "non_sql"),
    ("MATCH (n:A {id: <K>}) RETURN n", "non_sql"),
    ("MATCH (a)-[:KNOWS]->(b) WHERE a.id = <K> RETURN b", "non_sql"),
    ("WITH n MATCH (n)-[:R]->(m) RETURN m, <K>", "non_sql"),
    ("UNWIND [1, <K>] AS x RETURN x", "non_sql"),
    ("PREFIX a: <http://x> SELECT ?x ?y WHERE { ?x a:p <K> }", "non_sql"),
    ("SELECT price - (:cut) FROM t WHERE id = <K>", None),
    ("Let me look at order <K>", "unknown_verb"),
    ("  ;", "too_short"),
    (" ", "empty"),
]


def _quoted(text: str) -> str:
    """A literal of both engines: a backslash stands as chr(92), since only one of them takes it for an escape."""
    return " || chr(92) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\\"))


_CASE_TEXTS = {k: f" || {_K} || ".join(map(_quoted, text.split("<K>"))) for k, (text, _) in enumerate(GATE_CASES)}
GATE_CASE_ROWS = f"""
SELECT o_orderkey AS row_id, {_case(f"o_orderkey % {len(GATE_CASES)}", _CASE_TEXTS, "''")} AS sql
FROM orders
"""

_PARENTS = {
    "gate_cases": (GATE_CASE_ROWS, ()),
    "corpus_raw": (CORPUS_RAW, ()),
    "chat": (CHAT, ("corpus_raw",)),
    "outputs": (OUTPUTS, ("corpus_raw",)),
    "code_files": (CODE_FILES, ()),
}


def ctes(*names: str) -> str:
    """The ``WITH`` list that defines the named corpora, parents first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in _PARENTS[name][1]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        visit(n)
    return "WITH " + ", ".join(f"{n} AS ({_PARENTS[n][0]})" for n in ordered)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deals rows out to all cores when the files give fewer splits than that; large inputs stay put."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived corpus as a lazy DataFrame over the tables in ``sf_dir``."""
    # The table name stands on a line of its own; in braces it stands for the DataFrame.
    text = f"{ctes(name)} SELECT * FROM {name}"
    # Braces in the text of a statement are no parameters.
    text = text.replace("{", "{{").replace("}", "}}").replace("\nFROM orders\n", "\nFROM {orders}\n")
    df = spark.sql(text, orders=spread(table(spark, sf_dir, "orders"), "o_orderkey"))
    # The made-up column behaves like a stored one: filters on it do not copy its long expression.
    made = {"corpus_raw": "sql", "chat": "text", "outputs": "raw_output", "code_files": "content", "gate_cases": "sql"}[name]
    return compute_once(df, **{made: F.col(made)}).select(*df.columns)
