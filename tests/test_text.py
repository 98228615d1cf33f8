"""Edge rows for the column expressions."""

import pytest
from pyspark.sql import functions as F

from quarrysql.functions import chat, scoring, statements
from quarrysql.functions.text import compute_once, first_filled, strip


def test_strip_knows_all_white_space(value):
    texts = ["  a \t\n", " b　", "\x1fc\x0b", "  ", "a b", None]
    assert value(strip, texts) == ["a", "b", "c", "", "a b", None]


def test_first_filled(spark):
    df = spark.createDataFrame([(None, "", "c"), ("", None, None), ("a", "b", "c")], "a string, b string, c string")
    assert [r[0] for r in df.select(first_filled("a", "b", "c")).collect()] == ["c", "", "a"]


def test_compute_once_keeps_filters_above(spark):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("x"))
    out = compute_once(df, y=F.regexp_replace("x", "1", "2")).where("y = '2' AND id > 0")
    assert [tuple(r) for r in out.collect()] == [(1, "1", "2"), (2, "2", "2")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


TAGGED = "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\n Q <|im_end|>\n<|im_start|>assistant\n{}<|im_end|>\n"
LEGACY = "<|system|>\nS\n<|end|>\n<|user|>\nQ\n<|end|>\n<|assistant|>\n{}\n<|end|>"


@pytest.mark.parametrize(
    "text, sql",
    [
        (TAGGED.format("SELECT 1"), "SELECT 1"),
        (TAGGED.format("  \n "), ""),
        (LEGACY.format("SELECT\n1"), "SELECT\n1"),
        ("<|assistant|>SELECT 2<|end|>", "SELECT 2"),
        ("<|im_start|>assistant SELECT 3<|im_end|>", "SELECT 3"),
        ("<|assistant|> select 4", "select 4"),
        ("<|assistant|> sure, here it is", ""),
        ("no tags", ""),
        # An empty tagged answer falls through to the legacy one.
        (TAGGED.format("") + LEGACY.format("SELECT 5"), "SELECT 5"),
    ],
)
def test_assistant_sql(value, text, sql):
    assert value(chat.assistant_sql, [text]) == [sql]


def test_user_question(value):
    texts = [TAGGED.format("x"), LEGACY.format("x"), "<|user|>Q2<|end|>", "<|im_start|>user Q3<|im_end|>", "z" * 150]
    assert value(chat.user_question, texts) == ["Q", "Q", "Q2", "Q3", "z" * 100]
    assert value(chat.rebuilt_question, texts[3:]) == ["", ""]
    assert value(chat.legacy_question_key, [LEGACY.format("x").replace("Q", " QQ "), "none"]) == ["qq", None]


def test_chat_format(value):
    texts = [TAGGED, LEGACY, "<|user|>a<|end|>", "plain"]
    assert value(chat.chat_format, texts) == ["tagged", "legacy", "legacy_incomplete", "none"]


@pytest.mark.parametrize(
    "sql, fixed",
    [
        ("SELECT YEAR(d)", "SELECT EXTRACT(YEAR FROM d)"),
        ("SELECT YEAR(YEAR(d))", "SELECT YEAR(EXTRACT(YEAR FROM d))"),
        ("SELECT year( d )", "SELECT EXTRACT(YEAR FROM d )"),
        ("SELECT BIRTHDAY(d)", "SELECT BIRTHDAY(d)"),
        ("SELECT YEAR(f(d))", "SELECT YEAR(f(d))"),
        ("x > date_sub(NOW(), interval 3 month)", "x > NOW() - INTERVAL '3 months'"),
        ("DATE_ADD(a, INTERVAL 2 WEEK)", "DATE_ADD(a, INTERVAL 2 WEEK)"),
        ("DATE_ADD(a , INTERVAL 1 Year )", "a + INTERVAL '1 years'"),
        # One pass: the rewritten inner call is not rewritten again.
        (
            "DATE_SUB(DATE_SUB(x, INTERVAL 1 YEAR), INTERVAL 2 DAY)",
            "DATE_SUB(x - INTERVAL '1 years', INTERVAL 2 DAY)",
        ),
        ("STR_TO_DATE (a, b) < CURDATE( )", "TO_DATE(a, b) < CURRENT_DATE"),
        ("str_to_date(a, b)", "TO_DATE(a, b)"),
        ("DATE_SUB('$1', INTERVAL 1 DAY)", "'$1' - INTERVAL '1 days'"),
    ],
)
def test_mysql_to_postgres(value, sql, fixed):
    assert value(statements.mysql_to_postgres, [sql]) == [fixed]
    once = value(statements.mysql_to_postgres, [fixed])
    if "DATE_SUB(x -" not in fixed:
        assert once == [fixed]


def test_sqlite_to_postgres(value):
    assert value(statements.sqlite_to_postgres, ['a = "x" AND b = ""']) == ["a = 'x' AND b = \"\""]


@pytest.mark.parametrize(
    "text, now, compat",
    [
        ("WITH a AS (SELECT 1) SELECT * FROM a", False, True),
        ("WITH RECURSIVE t(n) AS (SELECT 1) SELECT n FROM t", False, True),
        ("SELECT (x::INT) FROM t", False, True),
        ("DROP TABLE matches", False, True),
        ("MATCH (n:Label) RETURN n", True, True),
        ("PREFIX a: SELECT ?x ?y", True, True),
        ("SELECT ?a ?b WHERE { ?a ?b }", True, True),
        ("SELECT 1 FROM t", False, False),
        ("CREATE (n)-[r:KNOWS]->(m)", True, True),
        ("", False, False),
        (None, False, False),
    ],
)
def test_is_non_sql(value, text, now, compat):
    assert value(statements.is_non_sql, [text]) == [now]
    assert value(lambda c: statements.is_non_sql(c, compat=True), [text]) == [compat]


@pytest.mark.parametrize(
    "sql, reason",
    [
        ("SELECT 1 FROM t", None),
        ("SELECT ';' FROM t;", None),
        ("-- note; more\nSELECT 1", None),
        ("(SELECT 1) UNION (SELECT 2)", None),
        (" ", "empty"),
        (None, "empty"),
        ("MATCH (n) RETURN n", "non_sql"),
        ("DROP", "too_short"),
        ("Sure, here you go", "unknown_verb"),
        ("SELECT 'a FROM t", "open_quote"),
        ("SELECT (1 FROM t", "open_parenthesis"),
        ("SELECT 1; SELECT 2", "many_statements"),
    ],
)
def test_gate(spark, sql, reason):
    df = spark.createDataFrame([(1, sql)], "i int, sql string")
    out = statements.gate(df)
    assert out.columns == ["i", "sql", "reject_reason"]
    assert out.first()["reject_reason"] == reason
    generic = statements.gate(df, lint=False).first()["reject_reason"]
    assert generic == (reason if reason in ("empty", "non_sql") else None)


def test_canonicalize_schema(value):
    ddl = "CREATE TABLE a (x  INT)\n \n\ncreate table b (foreign key ( x )references a ( y ))\t"
    want = "CREATE TABLE a (x INT)\n\ncreate table b (FOREIGN KEY ( x ) REFERENCES a( y ))"
    assert value(statements.canonicalize_schema, [ddl, "  ", None]) == [want, "", ""]


def test_sql_type(value):
    texts = [
        "/* a */ select 1", "--x\rSELECT\nINSERT INTO t", "-- only", "WITH a AS (SELECT 1) SELECT 1", "truncate t",
        "GRANT x", "^SELECT", "", None,
    ]
    want = ["SELECT", "INSERT", "EMPTY", "WITH (CTE)", "TRUNCATE", "OTHER", "OTHER", "EMPTY", None]
    assert value(statements.sql_type, texts) == want
    assert value(lambda c: statements.sql_type(c, permissions=True), ["grant a"]) == ["PERMISSIONS"]


def test_complexity(value):
    deep = (
        "WITH a AS (SELECT 1) SELECT x, SUM(y) OVER (PARTITION BY z) FROM a JOIN b GROUP BY x HAVING 1 UNION SELECT 2"
        " ORDER BY 1"
    )
    texts = ["SELECT 1", "SELECT 1 FROM a JOIN b", "SELECT f(a) FROM (SELECT 1)", ") SELECT (", deep]
    assert value(statements.complexity7, texts) == ["Simple", "Medium", "Medium", "Simple", "Very Complex"]
    assert value(statements.complexity9, texts[:2] + [deep]) == ["Simple", "Medium", "Very Complex"]


def test_describe_sql(value):
    texts = ["select a, b from t", "SELECT * FROM t", "INSERT INTO t VALUES (1)", "UPDATE t SET a", "DELETE FROM t",
             "CREATE TABLE IF NOT EXISTS t (a INT)", "SELECT 1", "DROP TABLE t", " SELECT 1 FROM t"]
    assert value(statements.describe_sql, texts) == [
        "Get A, B from T", "Get all records from T", "Insert a new record into T", "Update records in T",
        "Delete records from T", "Create table T", "Execute this SQL query", "Execute this SQL query",
        "Execute this SQL query",
    ]


def test_clean_output(value):
    texts = ["<think>a</think> SELECT 1; rest", "x", " ; y"]
    assert value(scoring.clean_output, texts) == ["a SELECT 1;", "x", ";"]
    assert value(scoring.after_marker, ["a ### SQL: b ### SQL:\nSELECT 1\n\n### end", "c"]) == ["SELECT 1", "c"]
    assert value(scoring.stop_cut, ["a\n\nb;c", "a;b"]) == ["a", "a"]


def test_keyword_coverage(spark):
    df = spark.createDataFrame(
        [("select a", ["SELECT", "select", "from", "x"]), ("a", [])], "sql string, need array<string>"
    )
    rows = df.select(scoring.keyword_coverage("sql", "need"), scoring.keywords_found("sql", "need")).collect()
    assert [tuple(r) for r in rows] == [(0.5, ["SELECT", "select"]), (0.0, [])]


def test_chatter_rules(value):
    texts = ["SELECT a FROM t", "Let me SELECT FROM", "EXPLAIN SELECT FROM", "Okay SELECT FROM", "SELECT 1"]
    assert value(lambda c: scoring.looks_like_sql(c, "checkpoints"), texts) == [True, False, False, True, False]
    assert value(lambda c: scoring.looks_like_sql(c, "detailed"), texts) == [True, False, True, False, False]
    assert value(lambda c: scoring.looks_like_sql(c, "packages"), texts) == [True, True, False, True, False]


def test_route_prompt(value):
    texts = ["Show all customers", "What is a table?", "hello", "Explain joins"]
    assert value(scoring.route_prompt, texts) == [True, False, False, False]


def test_disallowed_functions(value):
    texts = ["SELECT COUNT(*), NOW() FROM t WHERE a IN (1) AND foo (2) > 1", "SELECT 1"]
    assert value(scoring.disallowed_functions, texts) == [["FOO", "NOW"], []]


def test_schema_use_and_prefix(spark):
    df = spark.createDataFrame([("SELECT name FROM zz", "CREATE TABLE a (name X)"), ("zz", " ")], "sql string, ddl string")
    rows = [r["uses_schema"] for r in df.select(scoring.schema_use("sql", "ddl")["uses_schema"].alias("uses_schema")).collect()]
    assert rows == [True, False]


def test_expectations(spark):
    n, any_of = scoring.needle, scoring.any_of
    rules = F.array(any_of(n("NOT IN"), n("EXCEPT")), any_of(n("Treasury", "exact")))
    df = spark.createDataFrame([("a not in Treasury",), ("a except treasury",), ("Treasury",)], "sql string")
    assert [r[0] for r in df.select(scoring.meets("sql", rules)).collect()] == [True, False, False]


def test_looks_english(value):
    texts = ["How many of the orders are open?", "Quais os clientes de uma loja", ""]
    assert value(statements.looks_english, texts) == [True, False, True]


def test_patterns_know_all_scripts(value):
    texts = ["UPDATE\x1fñame SET a", "INSERT INTO\u2003日本 VALUES"]
    assert value(statements.describe_sql, texts) == ["Update records in ÑAME", "Insert a new record into 日本"]
    assert value(statements.mysql_to_postgres, ["éYEAR(a) + YEAR(\x1fé)"]) == ["éYEAR(a) + EXTRACT(YEAR FROM é)"]
    assert value(statements.canonicalize_schema, ["a\n\x1f\nb"]) == ["a\nb"]


def test_skeleton_takes_quotes_and_comments_in_their_order(value):
    cases = {
        "a = '--' AND b": "a = 0  AND b",
        "a -- it's\nb": "a  \nb",
        "/* ' */ a 'x /* y'": "  a 0 ",
        '"it\'s" \'a"b\'': "n  0 ",
        "'a''b' 'c": "0  'c",
        "E'\\'' e'a\\\\' x'": "0  0  x'",
        "$$ ' $$ $t$ $$ ' $t$ $1": "    $1",
        "`a'b` /* open": "n  /* open",
        "plain": "plain",
    }
    assert value(lambda c: statements.skeleton(c), list(cases)) == list(cases.values())
    long = "SELECT '" + "''" * 50_000 + "' /*" + "*" * 50_000 + "*/ FROM t"
    assert value(lambda c: statements.skeleton(c), [long, None]) == ["SELECT 0    FROM t", None]


def test_gate_takes_what_a_reader_takes(spark):
    from quarrysql.plans.derived import GATE_CASES

    df = spark.createDataFrame([(i, text.replace("<K>", "7")) for i, (text, _) in enumerate(GATE_CASES)], "i int, sql string")
    found = {r.i: r.reject_reason for r in statements.gate(df).collect()}
    assert [(GATE_CASES[i][0], found[i]) for i in sorted(found)] == list(GATE_CASES)
    loose = {r.i: r.reject_reason for r in statements.gate(df, lint=False).collect()}
    assert all(loose[i] == (why if why in ("empty", "non_sql") else None) for i, (_, why) in enumerate(GATE_CASES))


def test_instruction_without_a_cut(value):
    listed = ", ".join(f"c{i}" for i in range(30))
    sql = [f"SELECT {listed} FROM t", "SELECT * FROM t", "SELECT 1", None]
    shown = f"Get {listed.upper()} from T"
    assert value(lambda c: statements.describe_sql(c, None), sql) == [shown, "Get all records from T", "Execute this SQL query", "Execute this SQL query"]
    assert value(lambda c: statements.describe_sql(c), sql[:1]) == [f"Get {listed.upper()[:50]} from T"]


# What answers of a model get wrong, one pair of statements a kind, and what an answer has to hold to be right.
FAULTS = {
    "per group": ([["PARTITION BY"], ["ROW_NUMBER", "RANK"]], "SELECT g, v FROM t ORDER BY v DESC LIMIT 3",
                  "SELECT g, v FROM (SELECT g, v, ROW_NUMBER() OVER (PARTITION BY g ORDER BY v DESC) AS n FROM t) AS r WHERE n <= 3"),
    "running total": ([["OVER (ORDER BY"]], "SELECT d, SUM(q) OVER (PARTITION BY d ORDER BY d) FROM t", "SELECT d, SUM(q) OVER (ORDER BY d) FROM t"),
    "never": ([["NOT EXISTS", "IS NULL", "NOT IN"]], "SELECT c.n FROM c JOIN o ON o.c = c.id GROUP BY c.n",
              "SELECT c.n FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.c = c.id)"),
    "all joins": ([["JOIN O ON"], ["JOIN I ON"], ["HAVING"]], "SELECT u.n FROM u JOIN o ON o.u = u.id GROUP BY u.n HAVING COUNT(*) > 5",
                  "SELECT u.n FROM u JOIN o ON o.u = u.id JOIN i ON i.o = o.id GROUP BY u.n HAVING SUM(i.q) > 5"),
    "named part": ([["WITH"], ["AVG"]], "SELECT p.n, AVG(p.v) FROM p GROUP BY p.n", "WITH a AS (SELECT g, AVG(v) AS m FROM p GROUP BY g) SELECT p.n FROM p JOIN a ON a.g = p.g WHERE p.v > a.m"),
    "domain": ([["SPLIT_PART", "POSITION"]], "SELECT n FROM u WHERE mail LIKE '%@%'", "SELECT SPLIT_PART(mail, '@', 2) FROM u"),
    "month": ([["DATE_TRUNC", "EXTRACT"]], "SELECT d, SUM(v) FROM s GROUP BY d", "SELECT DATE_TRUNC('month', d), SUM(v) FROM s GROUP BY 1"),
    "second": ([["MAX"], ["< (SELECT"]], "SELECT n FROM p WHERE v = (SELECT MAX(v) FROM p)", "SELECT n FROM p WHERE v = (SELECT MAX(v) FROM p WHERE v < (SELECT MAX(v) FROM p))"),
    "exactly": ([["GROUP BY"], ["COUNT(*) = 2"]], "SELECT DISTINCT c FROM o", "SELECT c FROM o GROUP BY c HAVING COUNT(*) = 2"),
    "null": ([["IS NULL"]], "SELECT n FROM p WHERE g = NULL", "SELECT n FROM p WHERE g IS NULL"),
}


def test_rules_tell_faulty_answers_from_right_ones(spark):
    for kind, (groups, faulty, right) in FAULTS.items():
        rules = F.array(*[scoring.any_of(*[scoring.needle(n) for n in g]) for g in groups])
        df = spark.createDataFrame([(0, faulty), (1, right)], "i int, sql string")
        rows = statements.gate(df.withColumn("meets", scoring.meets("sql", rules))).orderBy("i").collect()
        assert [(r.meets, r.reject_reason) for r in rows] == [(False, None), (True, None)], kind


def test_faulty_dialect_is_rewritten(value):
    faulty = ["SELECT id FROM u WHERE d >= DATE_SUB(CURRENT_DATE, INTERVAL 30 DAY)", "SELECT YEAR(d) FROM u WHERE d < CURDATE()"]
    right = ["SELECT id FROM u WHERE d >= CURRENT_DATE - INTERVAL '30 days'", "SELECT EXTRACT(YEAR FROM d) FROM u WHERE d < CURRENT_DATE"]
    assert value(statements.mysql_to_postgres, faulty) == right
    assert value(statements.mysql_to_postgres, right) == right


def test_schema_of_another_table_is_not_used(spark):
    ddl = "CREATE TABLE orders (id INT, placed DATE)"
    df = spark.createDataFrame([("SELECT name FROM customers", ddl), ("SELECT placed FROM orders", ddl), ("SELECT name FROM users", "")], "sql string, ddl string")
    used = scoring.schema_use("sql", "ddl")
    assert [list(used)[-1]] and [r[0] for r in df.select(list(used.values())[-1]).collect()] == [False, True, False]
