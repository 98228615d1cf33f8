"""Column expressions that score generated SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrysql.functions.text import as_col, contains_any, strip, unicode_pattern

# Words that give away an explanation, one set per rule.
CHATTER = {
    "checkpoints": ("LET ME", "EXPLAIN"),
    "detailed": ("OKAY", "LET ME", "THE USER"),
    "packages": ("EXPLAIN",),
}

# The words that route a prompt to the SQL engine, and those that keep it away.
ROUTE_WORDS = (
    "sql", "database", "query", "text2sql", "table", "select", "join", "where", "from", "group by", "order by",
    "insert", "update", "delete", "users", "customers", "orders", "products", "find all", "find", "get all", "get",
    "show all", "show", "list all", "list", "older", "younger", "between", "count", "sum", "average",
)
ROUTE_EXCLUDED = (
    "what is", "what are", "explain", "meaning", "definition", "describe", "tell me about", "how does", "why",
)
ROUTE_PRIORITY = 0.85

# The functions generated SQL may call.
ALLOWED_FUNCTIONS = (
    "COUNT", "SUM", "AVG", "MIN", "MAX", "ROUND", "FLOOR", "CEIL",
    "UPPER", "LOWER", "LENGTH", "TRIM", "SUBSTR", "COALESCE", "CAST", "CONCAT",
)

# Words that may stand before a parenthesis without being a call.
NOT_CALLS = (
    "IN", "AS", "OVER", "VALUES", "AND", "OR", "NOT", "ON", "WHERE", "HAVING", "SELECT", "FROM", "EXISTS", "BY",
    "WHEN", "THEN", "ELSE", "CASE", "JOIN", "INTO", "TABLE", "KEY", "UNION", "ALL", "ANY", "LIKE", "BETWEEN", "USING",
)


def clean_output(raw: Column | str) -> Column:
    """Drop think tags (not what they enclose) and everything after the first ``;``."""
    c = F.replace(as_col(raw), F.lit("<think>"), F.lit(""))
    c = strip(F.replace(c, F.lit("</think>"), F.lit("")))
    return strip(F.when(c.contains(";"), F.concat(F.substring_index(c, ";", 1), F.lit(";"))).otherwise(c))


def after_marker(raw: Column | str) -> Column:
    """A64, other form: the text after the last ``### SQL:``, cut at the next section."""
    c = as_col(raw)
    body = strip(F.substring_index(c, "### SQL:", -1))
    return F.when(c.contains("### SQL:"), F.substring_index(body, "\n\n###", 1)).otherwise(c)


def stop_cut(raw: Column | str) -> Column:
    """A64, decoding form: cut at the first of the two stop sequences, ``;`` and a blank line."""
    return F.substring_index(F.substring_index(as_col(raw), ";", 1), "\n\n", 1)


def keywords_found(sql: Column | str, required: Column | str) -> Column:
    """The required words that occur in the statement, duplicates kept."""
    s = F.upper(as_col(sql))
    return F.filter(as_col(required), lambda w: s.contains(F.upper(w)))


def keyword_coverage(sql: Column | str, required: Column | str) -> Column:
    """Found words over required words; an empty list scores 0."""
    need = as_col(required)
    return F.when(F.size(need) > 0, F.size(keywords_found(sql, need)) / F.size(need)).otherwise(F.lit(0.0))


def looks_like_sql(sql: Column | str, rule: str = "checkpoints") -> Column:
    """SELECT and FROM occur and none of the rule's chatter does."""
    s = F.upper(as_col(sql))
    return s.contains("SELECT") & s.contains("FROM") & ~contains_any(s, CHATTER[rule])


def category_hit(sql: Column | str, category: Column | str) -> Column:
    """The category name occurs in the statement."""
    return F.upper(as_col(sql)).contains(F.upper(as_col(category)))


def schema_use(sql: Column | str, ddl: Column | str) -> dict[str, Column]:
    """SELECT, FROM, both, and any word of the schema."""
    s = as_col(sql)
    up, low = F.upper(s), F.lower(s)
    words = F.filter(F.split(F.lower(as_col(ddl)), unicode_pattern(r"\s+")), lambda w: w != "")
    return {
        "has_select": up.contains("SELECT"),
        "has_from": up.contains("FROM"),
        "has_both": up.contains("SELECT") & up.contains("FROM"),
        "uses_schema": F.exists(words, lambda w: low.contains(w)),
    }


def more_complete(candidate: Column | str, base: Column | str) -> Column:
    """The candidate is longer than half of the base."""
    return F.length(strip(candidate)) > F.length(strip(base)) * F.lit(0.5)


def select_prefix_ok(sql: Column | str) -> Column:
    """OK when SELECT opens the text or occurs in its first 50 characters."""
    s = F.upper(as_col(sql))
    return F.when(s.startswith("SELECT") | F.substring(s, 1, 50).contains("SELECT"), "OK").otherwise("FAIL")


def needle(text: str, mode: str = "upper") -> Column:
    """One substring test for :func:`meets`; ``mode`` is upper, lower or exact."""
    return F.struct(F.lit(text).alias("needle"), F.lit(mode).alias("mode"))


def any_of(*tests: Column) -> Column:
    return F.array(*tests)


def meets(sql: Column | str, rules: Column | str) -> Column:
    """Every group of ``rules`` holds a needle that occurs in the statement."""
    s = as_col(sql)
    up, low = F.upper(s), F.lower(s)

    def hit(test: Column) -> Column:
        word = test["needle"]
        return (
            F.when(test["mode"] == "upper", up.contains(word))
            .when(test["mode"] == "lower", low.contains(word))
            .otherwise(s.contains(word))
        )

    return F.forall(as_col(rules), lambda group: F.exists(group, hit))


def route_prompt(text: Column | str) -> Column:
    """Any route word and no excluded phrase."""
    t = F.lower(as_col(text))
    return contains_any(t, ROUTE_WORDS) & ~contains_any(t, ROUTE_EXCLUDED)


def function_calls(sql: Column | str) -> Column:
    """Distinct names that stand before a parenthesis, words that never are calls left out."""
    names = F.regexp_extract_all(F.upper(as_col(sql)), F.lit(unicode_pattern(r"(\w+)\s*\(")), F.lit(1))
    return F.array_except(F.array_distinct(names), F.array(*[F.lit(w) for w in NOT_CALLS]))


def disallowed_functions(sql: Column | str) -> Column:
    """Called names that are not on the allow-list, in order."""
    allowed = F.array(*[F.lit(w) for w in ALLOWED_FUNCTIONS])
    return F.sort_array(F.array_except(function_calls(sql), allowed))
