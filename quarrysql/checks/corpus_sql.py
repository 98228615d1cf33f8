"""The corpus operators as plain SQL, for the result check.

Small builders return SQL expressions; the check engine has no look-around, needs the flag ``g`` to
replace all matches, and counts ``.`` as any character under the flag ``s``.
"""

from __future__ import annotations

from quarrysql.functions import chat, scoring, statements
from quarrysql.functions.text import WHITE_SPACE
from quarrysql.operators import extract, quality
from quarrysql.plans.derived import GATE_CASES, ctes


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(WHITE_SPACE)})"


def rx(x: str, pattern: str, group: int = 1, flags: str = "s") -> str:
    return f"regexp_extract({x}, {lit(pattern)}, {group}, '{flags}')"


def sub(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, '{flags}')"


def hit(x: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({x}, {lit(pattern)}, '{flags}')" if flags else f"regexp_matches({x}, {lit(pattern)})"


def any_in(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def starts(x: str, words) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {lit(w)})" for w in words) + ")"


def bucket(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def hashed(key: str, salt: str) -> str:
    return f"md5('{salt}|' || CAST({key} AS VARCHAR))"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) * 100 / CAST({whole} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


# --- chat ------------------------------------------------------------------------------------

TAGGED = r"<\|im_start\|>{0}\n(.*?)<\|im_end\|>"
TAGGED_TIGHT = r"<\|im_start\|>{0}(.*?)<\|im_end\|>"
LEGACY = r"<\|{0}\|>\s*\n(.*?)\n<\|end\|>"
LEGACY_TIGHT = r"<\|{0}\|>(.*?)<\|end\|>"
LEGACY_STRICT = r"<\|{0}\|>\n(.*?)\n<\|end\|>"


def assistant(t: str) -> str:
    role = "assistant"
    tries = [f"nullif({strip(rx(t, p.format(role)))}, '')" for p in (TAGGED, LEGACY, LEGACY_TIGHT, TAGGED_TIGHT)]
    tail = strip(sub(strip(rx(t, r"<\|assistant\|>(.*)")), r"<\|end\|>.*", "", "gs"))
    tries.append(f"CASE WHEN {starts(f'upper({tail})', chat.OPEN_TAIL_VERBS)} THEN {tail} END")
    return f"coalesce({', '.join(tries)}, '')"


def first_match(t: str, role: str, patterns, otherwise: str) -> str:
    arms = " ".join(
        f"WHEN {hit(t, p.format(role), 's')} THEN {strip(rx(t, p.format(role)))}" for p in patterns
    )
    return f"CASE {arms} ELSE {otherwise} END"


def question(t: str) -> str:
    return first_match(t, "user", (TAGGED, LEGACY, LEGACY_TIGHT, TAGGED_TIGHT), f"substr({t}, 1, 100)")


def rebuilt_question(t: str) -> str:
    return first_match(t, "user", (TAGGED, LEGACY, LEGACY_TIGHT), "''")


def system(t: str, dialect: str = "sql") -> str:
    return first_match(t, "system", (TAGGED, LEGACY, LEGACY_TIGHT), lit(f"Dialect: {dialect}"))


def legacy_key(t: str) -> str:
    p = LEGACY_STRICT.format("user")
    return f"CASE WHEN {hit(t, p, 's')} THEN lower({strip(rx(t, p))}) END"


def no_think(x: str) -> str:
    return sub(x, "<think>.*?</think>", "", "gis")


def reasoning(x: str) -> str:
    u = f"upper({x})"
    return f"""CASE WHEN contains({u}, 'SELECT') THEN
        CASE WHEN contains({u}, 'JOIN') THEN 'I need to join tables to retrieve related data.'
             WHEN contains({u}, 'GROUP BY') THEN 'I need to aggregate data by grouping rows.'
             WHEN contains({u}, 'ORDER BY') THEN 'I need to retrieve and sort data based on the criteria.'
             ELSE 'I need to retrieve data from the database.' END
      WHEN contains({u}, 'INSERT') THEN 'I need to insert new data into the database.'
      WHEN contains({u}, 'UPDATE') THEN 'I need to update existing data in the database.'
      WHEN contains({u}, 'DELETE') THEN 'I need to delete data from the database.'
      WHEN contains({u}, 'CREATE') THEN 'I need to create a new database object.'
      ELSE 'I need to construct a SQL query to answer the question.' END"""


def mix(key: str = "row_id") -> str:
    return f"({bucket(key, 'reasoning')} % 4 <> 0)"


def with_reasoning(x: str, include: str) -> str:
    return f"CASE WHEN {include} THEN {lit('<think>' + chr(10))} || {reasoning(x)} || {lit(chr(10) + '</think>' + chr(10))} || {x} ELSE {x} END"


def turns(sys_: str, ask: str, answer: str) -> str:
    n = chr(10)
    return (
        f"{lit('<|im_start|>system' + n)} || {sys_} || {lit('<|im_end|>' + n + '<|im_start|>user' + n)} || {ask} || "
        f"{lit('<|im_end|>' + n + '<|im_start|>assistant' + n)} || ({answer}) || {lit('<|im_end|>' + n)}"
    )


def sys_turn(schema: str, dialect: str) -> str:
    return f"({lit(f'Dialect: {dialect}{chr(10)}Schema:{chr(10)}')} || {schema})"


def legacy_text(schema: str, ask: str, answer: str, dialect: str = "sql") -> str:
    n = chr(10)
    return (
        f"{lit('<|system|>' + n)} || {sys_turn(schema, dialect)} || {lit(f'{n}<|end|>{n}<|user|>{n}')} || {ask} || "
        f"{lit(f'{n}<|end|>{n}<|assistant|>{n}')} || {answer} || {lit(n + '<|end|>')}"
    )


# --- statements ------------------------------------------------------------------------------


def canonical(x: str) -> str:
    c = sub(x, r"\n\s*\n", "\n")
    c = sub(c, r"[ \t]+", " ")
    c = sub(c, r"(CREATE TABLE)", "\n\\1", "gi")
    fk = r"FOREIGN\s+KEY\s*\(([^)]+)\)\s*REFERENCES\s+(\w+)\s*\(([^)]+)\)"
    return f"coalesce({strip(sub(c, fk, 'FOREIGN KEY (' + chr(92) + '1) REFERENCES ' + chr(92) + '2(' + chr(92) + '3)', 'gi'))}, '')"


def describe(x: str, shown: int | None = 50) -> str:
    u = f"upper({x})"
    cols = strip(rx(u, r"SELECT\s+(.*?)\s+FROM"))
    table_of = rx(u, r"FROM\s+(\w+)")
    into, updated = rx(u, r"INTO\s+(\w+)"), rx(u, r"UPDATE\s+(\w+)")
    created = rx(u, r"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\w+)")
    return f"""CASE
      WHEN starts_with({u}, 'SELECT') AND {table_of} <> '' THEN
        CASE WHEN {cols} NOT IN ('', '*') THEN 'Get ' || {cols if shown is None else f'substr({cols}, 1, {shown})'} || ' from ' || {table_of}
             ELSE 'Get all records from ' || {table_of} END
      WHEN starts_with({u}, 'INSERT') AND {into} <> '' THEN 'Insert a new record into ' || {into}
      WHEN starts_with({u}, 'UPDATE') AND {updated} <> '' THEN 'Update records in ' || {updated}
      WHEN starts_with({u}, 'DELETE') AND {table_of} <> '' THEN 'Delete records from ' || {table_of}
      WHEN starts_with({u}, 'CREATE TABLE') AND {created} <> '' THEN 'Create table ' || {created}
      ELSE 'Execute this SQL query' END"""


def postgres(x: str) -> str:
    b = chr(92)
    c = x
    for p in ("YEAR", "MONTH", "DAY"):
        c = sub(c, rf"\b{p}\s*\(\s*([^()]+)\s*\)", f"EXTRACT({p} FROM {b}1)", "gi")
    for call, sign in (("DATE_SUB", "-"), ("DATE_ADD", "+")):
        c = sub(
            c, rf"\b{call}\s*\(\s*([^,]+?)\s*,\s*INTERVAL\s+(\d+)\s+(YEAR|MONTH|DAY)\s*\)",
            f"{b}1 {sign} INTERVAL '{b}2 \ue001{b}3s'", "gi",
        )
    for unit in ("year", "month", "day"):
        c = sub(c, f"\ue001{unit}", unit, "gi")
    c = sub(c, r"\bSTR_TO_DATE\s*\(", "TO_DATE(", "gi")
    return sub(c, r"\bCURDATE\s*\(\s*\)", "CURRENT_DATE", "gi")


# Quotes and comments in the order in which they are tried at each place; dollar quotes without a name only.
SKIPPED = "|".join((
    r"\b[eE](')(?:[^'\\]|\\.|'')*(')", r"(')[^']*(?:''[^']*)*(')", r'(")[^"]*(?:""[^"]*)*(")', r"(`)[^`]*(`)",
    r"\$\$.*?\$\$", r"--[^\n]*", r"/\*.*?\*/",
))


def skeleton(x: str) -> str:
    kept = sub(x, SKIPPED, "".join(f"{chr(92)}{k}" for k in range(1, 9)) + " ", "gs")
    for pair, stands in (("''", "0"), ('""', "n"), ("``", "n")):
        kept = f"replace({kept}, {lit(pair)}, '{stands}')"
    return strip(kept)


def non_sql(x: str, compat: bool = False) -> str:
    u = f"upper({strip(x)})" if compat else f"upper({skeleton(x)})"
    head = "false"
    if compat:
        opener, label = starts(u, statements.NON_SQL_OPENERS), hit(u, r"\([^)]*:\w+\)")
        word = any_in(u, statements.CYPHER_WORDS)
    else:
        opener = hit(u, "^(" + "|".join(statements.NON_SQL_OPENERS) + ")" + chr(92) + "b")
        call, yields = hit(u, r"^CALL\s+[\w.]+\s*\("), hit(u, r"\bYIELD\b")
        head = "(" + " OR ".join((
            hit(u, r"^WITH\s+(RECURSIVE\s+)?\w+\s*(\([^)]*\)\s*)?AS\s*((NOT\s+)?MATERIALIZED\s*)?\("),
            hit(u, r"^MERGE\s+(INTO\s+)?[\w.]+\s+((AS\s+)?\w+\s+)?USING\b"),
            hit(u, r"^DESCRIBE\s+((TABLE|EXTENDED|FORMATTED)\s+)*[\w.]+\s*(;|\z)"),
            f"({call} AND NOT {yields})",
        )) + ")"
        label = hit(u, r"\(\s*\w+:\w[^()]*\)|(->|\]-)\s*\(:\w[^()]*\)|\(:\w[^()]*\)\s*(<-|-\[|->)")
        word = hit(u, r"\b(" + "|".join(statements.CYPHER_WORDS) + r")\b")
    shapes = [
        r"-\[[^\]]*:\w+\]-", r"\bRETURN\s+[^\n]*\bWHERE\b", r"\bPREFIX\s+\w+:", r"\{\s*\?", r"\?\w+\s+\?\w+",
    ]
    shaped = " OR ".join([label, *[hit(u, p) for p in shapes]])
    return f"({u} <> '' AND ({shaped} OR (NOT {head} AND ({opener} OR ({word} AND NOT {any_in(u, statements.SQL_WORDS)})))))"


def lint(x: str, level: bool = True, compat: bool = False) -> str:
    s, b = strip(x), skeleton(x)
    verbs = ", ".join(lit(v) for v in (*statements.STATEMENT_VERBS, *statements.FURTHER_VERBS))
    verb = f"upper({rx(b, r'^[(\s]*([A-Za-z]+)')})"
    quoted = " OR ".join(f"contains({b}, {lit(q)})" for q in ("'", '"', "`"))
    more = f"""WHEN length({s}) < 5 THEN 'too_short'
      WHEN {verb} NOT IN ({verbs}) THEN 'unknown_verb'
      WHEN {quoted} THEN 'open_quote'
      WHEN contains({b}, '/*') THEN 'open_comment'
      WHEN length(replace({b}, '(', '')) <> length(replace({b}, ')', '')) THEN 'open_parenthesis'
      WHEN {hit(b, r';\s*[^\s;]')} THEN 'many_statements'"""
    return f"CASE WHEN coalesce({s}, '') = '' THEN 'empty' WHEN {non_sql(x, compat)} THEN 'non_sql' {more if level else ''} END"


def verdicts() -> str:
    """What a reader says of each case, by its number: nothing of the gate is used."""
    return " ".join(f"WHEN {k} THEN {lit(v) if v else 'NULL'}" for k, (_, v) in enumerate(GATE_CASES))


def kind(x: str, permissions: bool = False) -> str:
    s = strip(sub(sub(strip(f"upper({x})"), r"--[^\n]*", ""), r"/\*.*?\*/", "", "gs"))
    names = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "TRUNCATE")
    arms = " ".join(f"WHEN starts_with({s}, '{n}') THEN '{n}'" for n in names)
    extra = f"WHEN {starts(s, ('GRANT', 'REVOKE'))} THEN 'PERMISSIONS'" if permissions else ""
    return f"CASE WHEN {s} = '' THEN 'EMPTY' WHEN starts_with({s}, 'WITH') THEN 'WITH (CTE)' {arms} {extra} ELSE 'OTHER' END"


def coarse(x: str, labels: str = "lower") -> str:
    s = f"upper({strip(x)})"
    names = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER")
    arms = " ".join(f"WHEN starts_with({s}, '{n}') THEN '{n.lower() if labels == 'lower' else n}'" for n in names)
    cte = {"lower": "cte", "upper": "WITH (CTE)"}.get(labels)
    extra = f"WHEN starts_with({s}, 'WITH') THEN '{cte}'" if cte else ""
    return f"CASE {arms} {extra} ELSE '{'other' if labels == 'lower' else 'OTHER'}' END"


def category(k: str) -> str:
    return f"""CASE WHEN {k} = 'SELECT' THEN 'read' WHEN {k} IN ('INSERT', 'UPDATE', 'DELETE') THEN 'write'
      WHEN {k} IN ('CREATE', 'DROP', 'ALTER') THEN 'ddl' WHEN {k} = 'WITH (CTE)' THEN 'cte' ELSE 'other' END"""


def level(tests: list[str]) -> str:
    score = " + ".join(f"CAST({t} AS INTEGER)" for t in tests)
    return f"CASE WHEN {score} = 0 THEN 'Simple' WHEN {score} <= 2 THEN 'Medium' WHEN {score} <= 4 THEN 'Complex' ELSE 'Very Complex' END"


def common_features(u: str) -> list[str]:
    return [
        hit(u, r"\bJOIN\b"), hit(u, r"\(.*SELECT.*\)", "s"), hit(u, r"\bOVER\s*\("), hit(u, r"\bGROUP\s+BY\b"),
        hit(u, r"\bHAVING\b"), hit(u, r"\bUNION\b"),
    ]


def features(x: str) -> dict[str, str]:
    u = f"upper({x})"
    return {
        "has_join": hit(u, r"\bJOIN\b"), "has_subquery": hit(u, r"\(SELECT\b"), "has_window": hit(u, r"\bOVER\s*\("),
        "has_cte": hit(u, r"\bWITH\b"), "has_union": hit(u, r"\bUNION\b"),
        "has_aggregation": hit(u, r"\b(COUNT|SUM|AVG|MIN|MAX|GROUP BY)\b"), "has_having": hit(u, r"\bHAVING\b"),
        "has_order_by": hit(u, r"\bORDER BY\b"), "has_limit": hit(u, r"\bLIMIT\b"),
        "join_count": f"len(regexp_extract_all({u}, {lit(chr(92) + 'bJOIN' + chr(92) + 'b')}))",
        "subquery_count": f"len(regexp_extract_all({u}, {lit(chr(92) + '(SELECT' + chr(92) + 'b')}))",
    }


# --- scoring ---------------------------------------------------------------------------------


def clean(x: str) -> str:
    c = strip(f"replace(replace({x}, '<think>', ''), '</think>', '')")
    return strip(f"CASE WHEN contains({c}, ';') THEN split_part({c}, ';', 1) || ';' ELSE {c} END")


def sql_like(x: str, rule: str = "checkpoints") -> str:
    u = f"upper({x})"
    return f"(contains({u}, 'SELECT') AND contains({u}, 'FROM') AND NOT {any_in(u, scoring.CHATTER[rule])})"


def has_category(x: str) -> str:
    return f"contains(upper({x}), upper(category))"


SCORED = f"""scored AS (SELECT *, {sql_like('sql')} AS is_sql, {has_category('sql')} AS has_keyword
  FROM (SELECT *, {clean('raw_output')} AS sql FROM outputs) AS c)"""

RAW, CHAT, OUT, FILES = ctes("corpus_raw"), ctes("chat"), ctes("outputs"), ctes("code_files")
CASES = ctes("gate_cases")
OUT = f"{OUT}, {SCORED}"
TYPED = f"{RAW}, typed AS (SELECT *, {kind('sql')} AS sql_type FROM corpus_raw)"


def first_wins(source: str, key: str, order: str = "source_rank, row_id") -> str:
    return f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


QUOTA = "0.77::DOUBLE / (1.0::DOUBLE - 0.77::DOUBLE)"


def balanced(source: str) -> str:
    return f"""(SELECT * FROM {source} WHERE sql <> '' AND sql_type <> 'SELECT'
      UNION ALL SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (ORDER BY {hashed('row_id', 'rebalance')}, row_id) AS place
        FROM {source} WHERE sql <> '' AND sql_type = 'SELECT')
      WHERE place <= CASE WHEN (SELECT count(*) FROM {source} WHERE sql <> '' AND sql_type <> 'SELECT') = 0
        THEN 9000000000 ELSE floor((SELECT count(*) FROM {source} WHERE sql <> '' AND sql_type <> 'SELECT') * ({QUOTA})) END)"""


STAGED = f"""gated AS (SELECT * EXCLUDE (sql), {strip(postgres('sql'))} AS sql FROM corpus_raw),
  staged AS (SELECT *, {lint('sql')} AS reject_reason, {kind(no_think('sql'))} AS sql_type,
    {turns(sys_turn(canonical('schema_ddl'), 'postgres'), 'question', with_reasoning('sql', mix()))} AS text FROM gated),
  passed AS (SELECT * FROM staged WHERE reject_reason IS NULL AND length(text) BETWEEN 10 AND 2048),
  uniq AS {first_wins('passed', 'question')}"""

REBUILT = f"""parts AS (SELECT *, {strip(no_think(assistant('text')))} AS sql FROM chat),
  judged AS (SELECT *, CASE WHEN sql <> '' THEN {lint('sql')} END AS reject_reason FROM parts),
  asked AS (SELECT *, CASE WHEN sql <> '' AND reject_reason IS NULL THEN {rebuilt_question('text')}
      ELSE {question('text')} END AS question FROM judged)"""

STATEMENTS = f"""selected AS (SELECT * EXCLUDE (content), {strip('content')} AS content FROM code_files
    WHERE (lower(ext) IN ({', '.join(lit(e) for e in extract.SQL_EXTENSIONS)}) OR contains(lower(path), 'sql'))
      AND length({strip('content')}) >= 20),
  pieces AS (SELECT path, content,
      regexp_extract_all(content, {lit(r'(.*?)((?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|WITH)\s+.*?(?:;|\n\n|\z))')}, 1, 'is') AS gaps,
      regexp_extract_all(content, {lit(r'(.*?)((?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|WITH)\s+.*?(?:;|\n\n|\z))')}, 2, 'is') AS stmts,
      regexp_extract_all(content, {lit(r'CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\w+)\s*\([^)]+\)')}, 0, 'is') AS ddls,
      regexp_extract_all(content, {lit(r'CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\w+)\s*\([^)]+\)')}, 1, 'is') AS names
    FROM selected),
  numbered AS (SELECT path, content, i, stmts[i] AS stmt,
      list_sum(list_transform(gaps[1:i], lambda g: length(g)))
        + coalesce(list_sum(list_transform(stmts[1:i-1], lambda g: length(g))), 0) AS start
    FROM pieces, unnest(generate_series(1, len(stmts))) AS u(i)),
  plain AS (SELECT path, i, {strip('rtrim(' + strip('stmt') + ", ';')")} AS sql,
      coalesce(regexp_extract_all(substr(content, 1, CAST(start AS BIGINT)),
        {lit(r'CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(\w+)\s*\([^)]+\)')}, 0, 'is')[-1], '') AS schema_ddl FROM numbered),
  kept AS (SELECT * FROM plain WHERE length(sql) >= 10),
  ddl_rows AS (SELECT path, j, ddls[j] AS ddl, names[j] AS name FROM pieces, unnest(generate_series(1, len(ddls))) AS u(j)),
  found AS (
    SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY i) - 1 AS INTEGER) AS stmt_no,
      {describe('sql')} AS instruction, schema_ddl, sql, {coarse('sql')} AS type FROM kept
    UNION ALL
    SELECT d.path, CAST(coalesce(n, 0) + j - 1 AS INTEGER), 'Show the schema for table ' || name, ddl, ddl, 'schema'
    FROM ddl_rows d LEFT JOIN (SELECT path, count(*) AS n FROM kept GROUP BY path) k ON d.path = k.path)"""

FOUND = f"{FILES}, {STATEMENTS}"


def rows(values) -> str:
    return ", ".join("(" + ", ".join(lit(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in values)


_ISSUES = {
    "no_system": "NOT contains(text, '<|system|>')",
    "no_schema": "NOT contains(text, 'Schema:')",
    "no_user": "NOT contains(text, '<|user|>')",
    "no_assistant": "NOT contains(text, '<|assistant|>')",
    "few_end_tags": "(length(text) - length(replace(text, '<|end|>', ''))) / 7 < 3",
    "empty_sql": f"{strip('answer')} = ''",
    "empty_question": f"{strip('question')} = ''",
    "too_short": "length(text) < 50",
    "too_long": "length(text) > 2048",
}
_CHECKED = f"""checkable AS (SELECT row_id, text, CASE WHEN row_id % 50 = 49 THEN NULL ELSE true_question END AS question,
      {assistant('text')} AS answer, source AS context FROM chat),
  checked AS (SELECT row_id, CASE WHEN question IS NULL THEN 'missing_fields' ELSE
      concat_ws(',', {', '.join(f"CASE WHEN {t} THEN '{n}' END" for n, t in _ISSUES.items())}) END AS issues FROM checkable)"""

_MARKS = [("mysql", m) for m in quality.MYSQL_MARKS] + [("postgres", m) for m in quality.POSTGRES_MARKS]
_RESIDUE = f"""residue AS (SELECT dialect, marker, n,
    CASE WHEN dialect = 'mysql' THEN CASE WHEN n = 0 THEN 'ok' ELSE 'problem' END WHEN n > 0 THEN 'ok' ELSE 'info' END AS status
  FROM (SELECT dialect, marker, count(row_id) AS n FROM (VALUES {rows(_MARKS)}) AS m(dialect, marker)
    LEFT JOIN corpus_raw ON contains(upper(sql), marker) GROUP BY dialect, marker))"""

_STATS = f"""stats AS (SELECT n.source, total, schema_pct,
      {pct('coalesce(hits, 0)', 'new_unique')} AS overlap_rate
    FROM (SELECT source, count(*) AS total, CAST(count(*) FILTER (WHERE schema_ddl <> '' AND sql <> '') AS DOUBLE) * 100 / count(*) AS schema_pct
          FROM corpus_raw GROUP BY source) n
    JOIN (SELECT source, count(DISTINCT q) AS new_unique, count(*) FILTER (WHERE EXISTS
            (SELECT 1 FROM corpus_raw c WHERE c.source <> k.source AND lower({strip('c.question')}) = k.q)) AS hits
          FROM (SELECT source, lower({strip('question')}) AS q FROM corpus_raw) k GROUP BY source) o ON n.source = o.source)"""


def spaced(x: str) -> dict[str, str]:
    u = f"upper({strip(x)})"
    out = {
        f"has_{n.lower().replace(' ', '_')}": f"contains({u}, ' {n} ')"
        for n in ("JOIN", "UNION", "GROUP BY", "ORDER BY", "LIMIT")
    }
    out["has_subquery"] = f"len(regexp_extract_all({u}, 'SELECT')) > 1"
    return out


_REQUIRED = "['select', 'FROM', 'where', 'ORDER BY', 'select']"
_FOUND_WORDS = f"list_filter({_REQUIRED}, lambda w: contains(upper(sql), upper(w)))"
_COVERAGE = f"CAST(len({_FOUND_WORDS}) AS DOUBLE) / 5"

_CALLS = f"""list_distinct(regexp_extract_all(upper(sql), {lit(r'(\w+)\s*\(')}, 1))"""
_NOT_ALLOWED = ", ".join(lit(w) for w in (*scoring.NOT_CALLS, *scoring.ALLOWED_FUNCTIONS))

_ROUTE = f"({any_in('lower(text)', scoring.ROUTE_WORDS)} AND NOT {any_in('lower(text)', scoring.ROUTE_EXCLUDED)})"

_SPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITE_SPACE) + "]+"


def _stop_hits(words) -> str:
    return f"len(list_filter(string_split_regex(lower(text), {lit(chr(92) + 'P{L}+')}), lambda w: w IN ({', '.join(lit(w) for w in words)})))"


def merge_keys(source: str, columns: str) -> str:
    """Complete legacy transcripts that pass the gate, with both keys."""
    strict = strip(rx("text", LEGACY_STRICT.format("assistant")))
    whole = " AND ".join(f"contains(text, '{t}')" for t in chat.LEGACY_TAGS)
    return f"""(SELECT {columns}, {sub(strip('lower(sql)'), chr(92) + 's+', ' ')} AS sql_key,
        CASE WHEN {legacy_key('text')} = {strip(f"lower({describe('sql')})")} THEN {strip(f"lower({describe('sql', None)})")}
          ELSE coalesce({legacy_key('text')}, '') END AS question_key
      FROM (SELECT *, {strict} AS sql FROM (SELECT {columns} FROM {source}) AS s0 WHERE {whole}) AS s1
      WHERE sql <> '' AND {lint('sql')} IS NULL)"""


ROUNDS = 12


def greedy(source: str) -> str:
    """The two-key rule in rounds. Rows still open after the last one are kept, so that a miss shows."""
    steps = [f"o0 AS MATERIALIZED (SELECT * FROM {source})"]
    for i in range(ROUNDS):
        steps.append(f"""k{i} AS MATERIALIZED (SELECT * FROM o{i}
          QUALIFY row_id = min(row_id) OVER (PARTITION BY sql_key) AND row_id = min(row_id) OVER (PARTITION BY question_key))""")
        steps.append(f"""o{i + 1} AS MATERIALIZED (SELECT * FROM o{i} WHERE sql_key NOT IN (SELECT sql_key FROM k{i})
          AND question_key NOT IN (SELECT question_key FROM k{i}))""")
    union = " UNION ALL ".join(f"SELECT * FROM k{i}" for i in range(ROUNDS))
    return ", ".join(steps) + f", kept AS ({union} UNION ALL SELECT * FROM o{ROUNDS})"


CORPUS_SQL: dict[str, str] = {
    "a01_read_jsonl": f"""{CHAT} SELECT row_id AS id, text, NULL AS broken FROM chat WHERE row_id % 13 <> 5
        UNION ALL SELECT NULL, NULL, '{{"id": ' || CAST(row_id AS VARCHAR) || ', "text": "cut' FROM chat
        WHERE row_id % 13 = 5""",
    "a02_to_common": f"{RAW} SELECT row_id, source, schema_ddl, question, sql FROM corpus_raw",
    "a03_merge_sources": f"{RAW} SELECT row_id, source, source_rank, schema_ddl, question, sql FROM corpus_raw",
    "a04_cap_source": f"{RAW} SELECT row_id, sql FROM corpus_raw ORDER BY {hashed('row_id', 'cap')}, row_id LIMIT 1000",
    "a04_first_rows": f"{RAW} SELECT row_id, sql FROM corpus_raw ORDER BY row_id LIMIT 1000",
    "a05_write_text_jsonl": f"{CHAT} SELECT text FROM chat",
    "a06_corpus_metadata": f"""{CHAT} SELECT 'orders' AS source_dataset, 'postgres' AS dialect, 'chat' AS format,
        count(*) AS num_examples, CAST(sum(length(text)) AS BIGINT) AS text_chars,
        count(*) FILTER (WHERE {bucket('row_id', 'split')} % 10000 >= 1000) AS train_examples,
        count(*) FILTER (WHERE {bucket('row_id', 'split')} % 10000 < 1000) AS validation_examples FROM chat""",
    "a07_write_columnar": f"""{CHAT} SELECT row_id, text,
        CASE WHEN {bucket('row_id', 'split')} % 10000 < 1000 THEN 'validation' ELSE 'train' END AS split FROM chat""",
    "a08_select_sql_files": f"{FOUND} SELECT file_id, path, content FROM selected",
    "a09_scan_budget": f"""{FOUND} SELECT file_id, path FROM (SELECT file_id, path FROM code_files
          WHERE lower(ext) IN ({', '.join(lit(e) for e in extract.SQL_EXTENSIONS)}) OR contains(lower(path), 'sql')
          ORDER BY file_id LIMIT 1999)
        WHERE path IN (SELECT path FROM found) ORDER BY file_id LIMIT 100""",
    "a10_snapshot_write": f"{CHAT} SELECT row_id, text, 2 AS version FROM chat",
    "a11_assistant_sql": f"""{CHAT} SELECT row_id, {assistant('text')} AS sql,
        {strip(rx('text', LEGACY_STRICT.format('assistant')))} AS strict_sql FROM chat""",
    "a12_user_question": f"""{CHAT} SELECT row_id, {question('text')} AS question, {legacy_key('text')} AS merge_key,
        {rebuilt_question('text')} AS rebuilt FROM chat""",
    "a13_system_content": f"{CHAT} SELECT row_id, {system('text')} AS system FROM chat",
    "a14_strip_reasoning": f"{CHAT} SELECT row_id, {no_think(assistant('text'))} AS sql FROM chat",
    "a15_chat_format": f"""{CHAT} SELECT row_id, CASE WHEN contains(text, '<|im_start|>') THEN 'tagged'
        WHEN {' AND '.join(f"contains(text, '{t}')" for t in chat.LEGACY_TAGS)} THEN 'legacy'
        WHEN {any_in('text', chat.LEGACY_TAGS)} THEN 'legacy_incomplete' ELSE 'none' END AS format FROM chat""",
    "a16_extract_statements": f"{FOUND} SELECT path, stmt_no, instruction, sql, type FROM found",
    "a17_schema_context": f"{FOUND} SELECT path, stmt_no, schema_ddl FROM found",
    "a18_describe_sql": f"{RAW} SELECT row_id, {describe('sql')} AS instruction FROM corpus_raw",
    "a19_canonicalize_schema": f"{RAW} SELECT row_id, {canonical('schema_ddl')} AS schema_ddl FROM corpus_raw",
    "a20_reasoning_line": f"{RAW} SELECT row_id, {reasoning('sql')} AS reasoning FROM corpus_raw",
    "a21_render_chat": f"""{RAW} SELECT row_id, {turns(sys_turn('schema_ddl', 'sql'), 'question', with_reasoning('sql', mix()))}
        AS text FROM corpus_raw""",
    "a22_render_legacy": f"""{RAW} SELECT row_id, {legacy_text('schema_ddl', 'question', 'sql')} AS legacy,
        'Schema: ' || schema_ddl || chr(10) || chr(10) || 'Question: ' || question || chr(10) || chr(10) || 'Answer: ' || sql
        AS simple FROM corpus_raw""",
    "a23_reasoning_mix": f"{RAW} SELECT row_id, {mix()} AS with_reasoning FROM corpus_raw",
    "a24_rebuild_text": f"""{CHAT}, {REBUILT} SELECT row_id, question, reject_reason, CASE WHEN sql = '' THEN text
        WHEN reject_reason IS NULL THEN {turns(system('text'), 'question', with_reasoning('sql', mix()))} ELSE '' END AS text
        FROM asked""",
    "a25_encode_fixed": f"""WITH words AS (SELECT doc_id,
          list_filter(string_split_regex(text, {lit(_SPACE_CLASS)}), lambda w: w <> '') AS w FROM documents),
        vocab AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS token_id
          FROM (SELECT unnest(w) AS token FROM words) GROUP BY token),
        cuts AS (SELECT doc_id, unnest(generate_series(0, greatest(len(w) - 1, 0) // 1536)) AS win, w FROM words),
        places AS (SELECT doc_id, win, i, w[win * 1536 + i] AS token FROM cuts, unnest(generate_series(1, least(len(w) - win * 1536, 1536))) AS u(i)),
        ids AS (SELECT doc_id, win, list(token_id ORDER BY i) AS ids FROM places JOIN vocab USING (token) GROUP BY doc_id, win)
        SELECT doc_id, CAST(win AS BIGINT) AS "window", array_to_string(list_concat(coalesce(ids, []),
            list_transform(generate_series(1, 1536 - coalesce(len(ids), 0)), lambda x: 0)), ' ') AS input_ids,
          CAST(coalesce(len(ids), 0) AS BIGINT) AS mask_sum, CAST(1536 AS BIGINT) AS label_count
        FROM cuts LEFT JOIN ids USING (doc_id, win)""",
    "a26_mysql_to_postgres": f"{RAW} SELECT row_id, {postgres('sql')} AS sql FROM corpus_raw",
    "a27_sqlite_to_postgres": f"{RAW} SELECT row_id, {sub('sql', chr(34) + '([^' + chr(34) + ']+)' + chr(34), chr(39) + chr(92) + '1' + chr(39))} AS sql FROM corpus_raw",
    "a28_is_non_sql": f"{RAW} SELECT row_id, {non_sql('sql')} AS non_sql, {non_sql('sql', True)} AS non_sql_compat FROM corpus_raw",
    "a29_gate_cases": f"{CASES} SELECT row_id, CASE row_id % {len(GATE_CASES)} {verdicts()} END AS reject_reason FROM gate_cases",
    "a29_statement_gate": f"""{RAW}, gated AS (SELECT row_id, {strip(postgres('sql'))} AS sql FROM corpus_raw)
        SELECT row_id, sql, {lint('sql')} AS reject_reason, {lint('sql', False, True)} AS generic_reason FROM gated""",
    "a30_length_filter": "SELECT doc_id, length(text) AS len FROM documents WHERE length(text) BETWEEN 10 AND 2048",
    "a31_required_fields": f"""{RAW} SELECT row_id FROM corpus_raw WHERE {strip('question')} <> '' AND {strip('sql')} <> ''
        AND {strip('schema_ddl')} <> ''""",
    "a32_english_only": "SELECT doc_id, source FROM documents WHERE lang = 'en'",
    "a32_english_by_words": f"""SELECT doc_id FROM documents
        WHERE {_stop_hits(statements.ENGLISH_WORDS)} >= {_stop_hits(statements.PORTUGUESE_WORDS)}""",
    "a33_sanitize_answer": f"{RAW} SELECT row_id, {strip('sql')} AS sql FROM corpus_raw",
    "a34_dedup_first": f"{RAW} SELECT row_id, question FROM {first_wins('corpus_raw', 'question')}",
    "a35_anti_existing": f"""{RAW} SELECT row_id, question FROM {first_wins(
        f"(SELECT *, lower({strip('question')}) AS q FROM corpus_raw WHERE o_orderstatus <> 'F')", 'q')}
        WHERE q NOT IN (SELECT lower({strip('question')}) FROM corpus_raw WHERE o_orderstatus = 'F')""",
    "a36_dedup_greedy": f"""{CHAT}, cands AS MATERIALIZED {merge_keys('chat', 'row_id, text, o_orderstatus')},
        fresh AS (SELECT row_id, sql_key, question_key FROM cands WHERE o_orderstatus <> 'F' AND question_key NOT IN
          (SELECT question_key FROM cands WHERE o_orderstatus = 'F' AND question_key <> '')),
        {greedy('fresh')} SELECT row_id, sql_key, question_key FROM kept""",
    "a37_dedup_prefix": f"{RAW} SELECT row_id, sql FROM {first_wins('corpus_raw', 'substr(sql, 1, 200)')}",
    "a38_append_source": f"""{RAW} SELECT 0 AS part, question AS text FROM corpus_raw WHERE o_orderstatus = 'F'
        UNION ALL SELECT 1, question FROM {first_wins(
        f"(SELECT *, lower({strip('question')}) AS q FROM corpus_raw WHERE o_orderstatus <> 'F')", 'q')}
        WHERE q NOT IN (SELECT lower({strip('question')}) FROM corpus_raw WHERE o_orderstatus = 'F')""",
    "a39_rebalance": f"{TYPED} SELECT row_id, sql_type FROM {balanced('typed')}",
    "a40_rebalance_report": f"""{TYPED}, picked AS {balanced('typed')},
        b AS (SELECT sql_type, count(*) AS n FROM typed GROUP BY 1), a AS (SELECT sql_type, count(*) AS n FROM picked GROUP BY 1)
        SELECT b.sql_type, b.n AS n_before, coalesce(a.n, 0) AS n_after,
          b.n * 100.0::DOUBLE / (SELECT count(*) FROM typed) AS pct_before,
          coalesce(a.n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM picked) AS pct_after, b.n - coalesce(a.n, 0) AS removed
        FROM b LEFT JOIN a ON a.sql_type = b.sql_type""",
    "a41_shuffle": f"{RAW} SELECT row_id, {hashed('row_id', 'shuffle')} AS h FROM corpus_raw ORDER BY h, row_id",
    "a42_train_val_split": f"""{RAW} SELECT row_id,
        CASE WHEN {bucket('row_id', 'split')} % 10000 < 1000 THEN 'validation' ELSE 'train' END AS split FROM corpus_raw""",
    "a42_exact_split": f"""{RAW} SELECT row_id, CASE WHEN place <= ceil((SELECT count(*) FROM corpus_raw) * 0.1::DOUBLE)
          THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT row_id, row_number() OVER (ORDER BY {hashed('row_id', 'split')}, row_id) AS place FROM corpus_raw)""",
    "a43_sql_type": f"{RAW} SELECT row_id, {kind('sql')} AS sql_type, {kind('sql', True)} AS sql_type_permissions FROM corpus_raw",
    "a44_sql_type_coarse": f"""{RAW} SELECT row_id, {coarse('sql')} AS lower_label, {coarse('sql', 'upper')} AS upper_label,
        {coarse('sql', 'plain')} AS plain_label FROM corpus_raw""",
    "a45_complexity7": f"{RAW} SELECT row_id, {level([*common_features('upper(sql)'), starts('upper(sql)', ('WITH',))])} AS complexity FROM corpus_raw",
    "a46_complexity9": f"""{RAW} SELECT row_id, {level([*common_features('upper(sql)'), hit('upper(sql)', r'\bORDER\s+BY\b'),
        hit('upper(sql)', r'\bWITH\s+\w+\s+AS\s*\('), hit('upper(sql)', r'\bCASE\s+WHEN\b')])} AS complexity FROM corpus_raw""",
    "a47_sql_features": f"{RAW} SELECT row_id, {', '.join(f'{e} AS {n}' for n, e in features('sql').items())} FROM corpus_raw",
    "a48_pattern_counts": f"""{RAW} {' UNION ALL '.join(
        f"SELECT '{n}' AS pattern, count(*) FILTER (WHERE {e}) AS n, count(*) FILTER (WHERE {e}) * 100.0::DOUBLE / count(*) AS pct FROM corpus_raw"
        for n, e in spaced('sql').items())}""",
    "a49_type_distribution": f"""{TYPED} SELECT sql_type, count(*) AS n,
          count(*) * 100.0::DOUBLE / (SELECT count(*) FROM typed WHERE sql <> '') AS pct FROM typed WHERE sql <> '' GROUP BY 1
        UNION ALL SELECT '(no sql)', count(*), NULL FROM typed WHERE sql = '' HAVING count(*) > 0""",
    "a50_label_distribution": f"""{RAW} SELECT task_label, count(*) AS n,
        count(*) * 100.0::DOUBLE / (SELECT count(*) FROM corpus_raw) AS pct FROM corpus_raw WHERE task_label IS NOT NULL GROUP BY 1""",
    "a51_category_rollup": f"""{TYPED} SELECT {category('sql_type')} AS category, count(*) AS n,
        count(*) * 100.0::DOUBLE / (SELECT count(*) FROM typed) AS pct FROM typed GROUP BY 1""",
    "a52_balance_verdict": f"""{TYPED} SELECT form, n, select_pct, CASE WHEN select_pct > high THEN 'almost only select'
          WHEN select_pct > low THEN 'mostly select' ELSE 'diverse' END AS verdict
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE sql_type = 'SELECT') * 100.0::DOUBLE / count(*) AS select_pct FROM typed),
          (VALUES ('corpus', 90, 70), ('source', 95, 80)) AS f(form, high, low)""",
    "a53_feature_rates": f"""{RAW} SELECT count(*) AS n, {', '.join(
        f"avg(CAST({e} AS DOUBLE)) FILTER (WHERE sql <> '') AS {n}" for n, e in features('sql').items())},
        avg(length(sql)) FILTER (WHERE sql <> '') AS avg_sql_length,
        avg(length(question)) FILTER (WHERE sql <> '') AS avg_question_length,
        CAST(count(*) FILTER (WHERE sql <> '' AND schema_ddl <> '') AS DOUBLE) / count(*) AS has_schema FROM corpus_raw""",
    "a54_detect_roles": f"""{RAW} SELECT source, count(*) AS n,
          CASE source WHEN 'synthetic' THEN NULL WHEN 'community' THEN 'sql' ELSE 'response' END AS sql,
          CASE source WHEN 'synthetic' THEN 'question' WHEN 'fixes' THEN 'instruction' END AS question,
          CASE source WHEN 'synthetic' THEN 'context' WHEN 'community' THEN 'sql_context' ELSE 'input' END AS schema,
          CASE source WHEN 'synthetic' THEN 'context' WHEN 'community' THEN 'sql_context' END AS overlap_question
        FROM corpus_raw GROUP BY source""",
    "a55_dataset_summary": f"""{RAW} SELECT (SELECT count(*) FROM corpus_raw) AS total, position, column_name,
          CASE WHEN length(v) > 60 THEN substr(v, 1, 60) || '...' ELSE v END AS sample
        FROM (SELECT * FROM corpus_raw ORDER BY row_id LIMIT 1), (VALUES (0, 'row_id'), (1, 'source'), (2, 'schema_ddl'),
          (3, 'question'), (4, 'sql')) AS c(position, column_name),
        LATERAL (SELECT CASE column_name WHEN 'row_id' THEN CAST(row_id AS VARCHAR) WHEN 'source' THEN source
          WHEN 'schema_ddl' THEN schema_ddl WHEN 'question' THEN question ELSE sql END AS v)""",
    "a56_overlap": f"""{RAW}, f AS (SELECT lower({strip('question')}) AS q FROM corpus_raw WHERE o_orderstatus <> 'F'),
        k AS (SELECT DISTINCT lower({strip('question')}) AS q FROM corpus_raw WHERE o_orderstatus = 'F')
        SELECT count(DISTINCT q) AS new_unique, count(*) FILTER (WHERE q IN (SELECT q FROM k)) AS overlapping_rows,
          count(DISTINCT q) FILTER (WHERE q IN (SELECT q FROM k)) AS overlapping_unique,
          count(*) FILTER (WHERE q IN (SELECT q FROM k)) * 100.0::DOUBLE / count(DISTINCT q) AS overlap_rate,
          count(DISTINCT q) FILTER (WHERE q IN (SELECT q FROM k)) * 100.0::DOUBLE / count(DISTINCT q) AS unique_overlap_rate
        FROM f WHERE q <> ''""",
    "a57_scorecard": f"""{RAW}, {_STATS} SELECT *,
          CASE WHEN total > 50000 THEN 'large' WHEN total > 10000 THEN 'medium' ELSE 'small' END AS size_label,
          CASE WHEN overlap_rate < 10 THEN 'low' WHEN overlap_rate < 30 THEN 'moderate' ELSE 'high' END AS overlap_label,
          CASE WHEN schema_pct > 80 THEN 'has schema' WHEN schema_pct > 50 THEN 'partial' ELSE 'missing' END AS schema_label,
          CAST(total > 10000 AS INTEGER) + CAST(overlap_rate < 20 AS INTEGER) + CAST(schema_pct > 70 AS INTEGER) AS score,
          CASE WHEN CAST(total > 10000 AS INTEGER) + CAST(overlap_rate < 20 AS INTEGER) + CAST(schema_pct > 70 AS INTEGER) >= 2
            THEN 'recommended' WHEN CAST(total > 10000 AS INTEGER) + CAST(overlap_rate < 20 AS INTEGER)
            + CAST(schema_pct > 70 AS INTEGER) = 1 THEN 'consider' ELSE 'not recommended' END AS verdict FROM stats""",
    "a58_compare_corpora": f"""{RAW}, t AS (SELECT o_orderstatus = 'F' AS cur, {category(coarse('sql', 'plain'))} AS category FROM corpus_raw)
        SELECT category, coalesce(count(*) FILTER (WHERE cur) * 100.0::DOUBLE / (SELECT count(*) FROM t WHERE cur), 0) AS current,
          coalesce(count(*) FILTER (WHERE NOT cur) * 100.0::DOUBLE / (SELECT count(*) FROM t WHERE NOT cur), 0) AS incoming
        FROM t GROUP BY category""",
    "a59_row_checks": f"{CHAT}, {_CHECKED} SELECT row_id, issues FROM checked",
    "a60_issue_report": f"""{CHAT}, {_CHECKED} SELECT issue, count(*) AS n
        FROM (SELECT unnest(string_split(issues, ',')) AS issue FROM checked WHERE issues <> '') GROUP BY issue""",
    "a61_readiness": f"""{CHAT}, a AS (SELECT text, {strip(rx('text', TAGGED.format('assistant')))} AS answer FROM chat),
        r AS (SELECT count(*) AS n, avg(CAST(contains(text, '<|im_start|>') AS DOUBLE)) AS tagged_rate,
          avg(CAST(contains(answer, '<think>') AS DOUBLE)) AS reasoning_rate,
          avg(CAST(NOT contains(answer, '<think>') AND {starts('answer', chat.DIRECT_VERBS)} AS DOUBLE)) AS direct_rate FROM a)
        SELECT *, CASE WHEN reasoning_rate BETWEEN 0.7 AND 0.8 THEN 'ok' WHEN reasoning_rate < 0.7 THEN 'too few'
          ELSE 'too many' END AS reasoning_label, tagged_rate >= 0.95 AND reasoning_rate BETWEEN 0.7 AND 0.8 AS ready FROM r""",
    "a62_dialect_residue": f"{RAW}, {_RESIDUE} SELECT * FROM residue",
    "a62_residue_verdict": f"""{RAW}, {_RESIDUE} SELECT CAST(sum(n) FILTER (WHERE dialect = 'mysql') AS BIGINT) AS mysql_hits,
        CASE WHEN sum(n) FILTER (WHERE dialect = 'mysql') = 0 THEN 'clean' ELSE 'residue' END AS verdict FROM residue""",
    "a63_sample_rows": f"""{RAW}, p AS (SELECT row_id, question, {postgres('sql')} AS sql FROM corpus_raw)
        SELECT * FROM p WHERE contains(upper(sql), 'EXTRACT') ORDER BY row_id LIMIT 5""",
    "a64_clean_output": f"""{OUT} SELECT case_id, model, sql, CASE WHEN contains(raw_output, '### SQL:')
          THEN split_part({strip("split_part(raw_output, '### SQL:', -1)")}, chr(10) || chr(10) || '###', 1) ELSE raw_output END AS marked,
        split_part(split_part(raw_output, ';', 1), chr(10) || chr(10), 1) AS stopped FROM scored""",
    "a65_keyword_coverage": f"""{OUT} SELECT case_id, model, array_to_string({_FOUND_WORDS}, ',') AS found,
        {_COVERAGE} AS score FROM scored""",
    "a66_looks_like_sql": f"""{OUT} SELECT case_id, model, {', '.join(
        f"{sql_like('sql', r)} AS {r}" for r in scoring.CHATTER)} FROM scored""",
    "a67_category_hit": f"{OUT} SELECT case_id, model, has_keyword FROM scored",
    "a68_leaderboard": f"""{OUT}, b AS (SELECT model, count(*) FILTER (WHERE is_sql) AS sql_hits,
          count(*) FILTER (WHERE has_keyword) AS keyword_hits, count(*) AS total FROM scored GROUP BY model)
        SELECT *, row_number() OVER (ORDER BY sql_hits DESC, list_position(['base', 'step_500', 'step_1000'], model)) = 1 AS best FROM b""",
    "a69_version_diff": f"""{OUT}, d AS (SELECT c.case_id, c.category, CASE WHEN c.is_sql AND NOT p.is_sql THEN 'now valid'
          WHEN NOT c.is_sql AND p.is_sql THEN 'no longer valid'
          WHEN c.has_keyword AND NOT p.has_keyword THEN 'now has keyword'
          WHEN NOT c.has_keyword AND p.has_keyword THEN 'lost keyword' END AS change
          FROM scored c JOIN scored p ON c.case_id = p.case_id WHERE c.model = 'step_1000' AND p.model = 'step_500')
        SELECT * FROM d WHERE change IS NOT NULL""",
    "a70_pass_rule": f"""{OUT}, s AS (SELECT case_id, model, {_COVERAGE} AS score FROM scored)
        SELECT b.case_id, b.score AS base_score, c.score AS candidate_score, c.score >= b.score * 0.8::DOUBLE AS passed
        FROM s b JOIN s c ON b.case_id = c.case_id WHERE b.model = 'base' AND c.model = 'step_1000'""",
    "a71_side_by_side": f"""{OUT} SELECT case_id, category, max(raw_output) FILTER (WHERE model = 'base') AS base_output,
        'step_1000=' || max(raw_output) FILTER (WHERE model = 'step_1000') || '|step_500='
          || max(raw_output) FILTER (WHERE model = 'step_500') AS model_outputs FROM scored GROUP BY case_id, category""",
    "a71_comparison_table": f"""{OUT} SELECT case_id, category, {', '.join(
        f"bool_or({f}) FILTER (WHERE model = '{m}') AS {m}_{f}" for m in ('base', 'step_500', 'step_1000')
        for f in ('is_sql', 'has_keyword'))} FROM scored GROUP BY case_id, category""",
    "a72_delta_summary": f"""{OUT}, m AS (SELECT case_id, model, 'is_sql' AS measure, is_sql AS h FROM scored
          UNION ALL SELECT case_id, model, 'has_keyword', has_keyword FROM scored),
        g AS (SELECT measure, count(*) FILTER (WHERE model = 'base') AS cases,
          count(*) FILTER (WHERE model = 'base' AND h) AS base_hits,
          count(*) FILTER (WHERE model = 'step_1000' AND h) AS candidate_hits FROM m GROUP BY measure)
        SELECT *, candidate_hits - base_hits AS improvement, base_hits * 100.0::DOUBLE / cases AS base_pct,
          candidate_hits * 100.0::DOUBLE / cases AS candidate_pct,
          (candidate_hits - base_hits) * 100.0::DOUBLE / cases AS improvement_pct FROM g""",
    "a73_schema_use": f"""{OUT} SELECT case_id, model, contains(upper(sql), 'SELECT') AS has_select,
        contains(upper(sql), 'FROM') AS has_from, contains(upper(sql), 'SELECT') AND contains(upper(sql), 'FROM') AS has_both,
        len(list_filter(string_split_regex(lower(schema_ddl), {lit(chr(92) + 's+')}),
          lambda w: w <> '' AND contains(lower(sql), w))) > 0 AS uses_schema FROM scored""",
    "a73_more_complete": f"""{OUT} SELECT c.case_id,
        length({strip('c.raw_output')}) > length({strip('b.raw_output')}) * 0.5 AS more_complete
        FROM scored c JOIN scored b ON c.case_id = b.case_id WHERE c.model = 'step_1000' AND b.model = 'base'""",
    "a74_select_prefix_ok": f"""{OUT} SELECT case_id, model, CASE WHEN contains(substr(upper(raw_output), 1, 50), 'SELECT')
        THEN 'OK' ELSE 'FAIL' END AS verdict FROM scored""",
    "a75_expectation_checks": f"""{OUT} SELECT case_id, model, CASE category
          WHEN 'JOIN' THEN contains(upper(sql), 'SELECT') AND (contains(upper(sql), 'JOIN') OR contains(lower(sql), 'customer_id'))
          WHEN 'HAVING' THEN contains(upper(sql), 'GROUP BY') AND (contains(upper(sql), 'HAVING') OR contains(upper(sql), 'COUNT'))
          ELSE contains(upper(sql), 'SELECT') AND (contains(sql, 'orders') OR contains(sql, 'Customer')) END AS meets FROM scored""",
    "a76_route_prompt": f"""SELECT conv_id, turn, {_ROUTE} AS routed,
        CASE WHEN {_ROUTE} THEN 0.85::DOUBLE ELSE 0.0::DOUBLE END AS priority FROM conversations WHERE role = 'user'""",
    "a77_function_allowlist": f"""{RAW} SELECT row_id, array_to_string(list_sort(list_filter({_CALLS},
        lambda f: f NOT IN ({_NOT_ALLOWED}))), ',') AS disallowed FROM corpus_raw""",
    "a78_run_report": f"""{RAW}, {STAGED} SELECT source, count(*) AS rows_in, count(reject_reason) AS refused,
        count(*) - count(reject_reason) AS kept, (count(*) - count(reject_reason)) * 100.0::DOUBLE / count(*) AS success_pct
        FROM staged GROUP BY source""",
    "a78_reject_report": f"""{RAW}, {STAGED} SELECT source, reject_reason, count(*) AS n FROM staged
        WHERE reject_reason IS NOT NULL GROUP BY source, reject_reason""",
    "a78_ledger": f"""{RAW}, {STAGED}, bal AS {balanced('uniq')}, outcomes AS (
        SELECT row_id, source, CASE WHEN reject_reason IS NOT NULL THEN 'refused: ' || reject_reason WHEN length(text) NOT BETWEEN 10 AND 2048 THEN 'length'
          WHEN row_id NOT IN (SELECT row_id FROM uniq) THEN 'duplicate' WHEN coalesce(sql, '') = '' THEN 'no_sql'
          WHEN row_id NOT IN (SELECT row_id FROM bal) THEN 'rebalanced' ELSE 'final' END AS outcome FROM staged)
        SELECT source, outcome, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY source) AS pct
        FROM outcomes GROUP BY source, outcome""",
    "a78_file_report": f"""{FOUND}, uniqf AS {first_wins('found', 'sql', 'path, stmt_no')},
        named AS (SELECT path FROM code_files
          WHERE lower(ext) IN ({', '.join(lit(e) for e in extract.SQL_EXTENSIONS)}) OR contains(lower(path), 'sql'))
        SELECT (SELECT count(*) FROM named) AS files_checked, count(DISTINCT path) AS files_with_sql,
          (SELECT count(*) FROM uniqf WHERE {lint('sql')} IS NULL) AS valid_statements,
          count(DISTINCT path) * 100.0::DOUBLE / (SELECT count(*) FROM named) AS success_pct FROM found""",
    "e1_curated_corpus": f"{RAW}, {STAGED} SELECT row_id, sql_type, text FROM {balanced('uniq')}",
    "e2_code_transcripts": f"""{FOUND}, uniqf AS {first_wins('found', 'sql', 'path, stmt_no')}
        SELECT path, stmt_no, {legacy_text('schema_ddl', 'instruction', 'sql')} AS text FROM uniqf WHERE {lint('sql')} IS NULL""",
    "e2_merged_corpus": f"""{ctes('chat', 'code_files')}, {STATEMENTS.replace('kept', 'long_enough')},
        uniqf AS {first_wins('found', 'sql', 'path, stmt_no')},
        scripts AS (SELECT row_number() OVER (ORDER BY path, stmt_no) AS row_id,
          {legacy_text('schema_ddl', 'instruction', 'sql')} AS text FROM uniqf WHERE {lint('sql')} IS NULL),
        cands AS MATERIALIZED {merge_keys('scripts', 'row_id, text')},
        fresh AS (SELECT * FROM cands WHERE question_key NOT IN
          (SELECT q FROM (SELECT {legacy_key('text')} AS q FROM chat) AS c WHERE q <> '')),
        {greedy('fresh')} SELECT 0 AS part, text FROM chat UNION ALL SELECT 1, text FROM kept""",
}
