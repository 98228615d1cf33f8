"""Column helpers shared by all operators. Everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space when trimming text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)


def unicode_pattern(pattern: str, flags: str = "") -> str:
    """A pattern whose classes cover all scripts, and whose ``\\s`` also covers the four separators U+001C-1F."""
    return f"(?{flags}U)" + pattern.replace(r"\s", r"[\s\x1c-\x1f]")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space; plain ``trim`` only knows the blank."""
    return F.trim(as_col(c), F.lit(WHITE_SPACE))


def lower_strip(c: Column | str) -> Column:
    return F.lower(strip(c))


def filled(c: Column | str) -> Column:
    """Null instead of the empty string."""
    return F.nullif(as_col(c), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[filled(c) for c in cols], F.lit(""))


def starts_with_any(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | c.startswith(word)
    return hit


def contains_any(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def hash_hex(key: Column | str, salt: str) -> Column:
    """Stable 128-bit hash of a key, as hex text. Orders rows the same way on every run and cluster size."""
    return F.md5(F.concat(F.lit(f"{salt}|"), as_col(key).cast("string")))


def hash_bucket(key: Column | str, salt: str) -> Column:
    """The first 32 bits of :func:`hash_hex` as a bigint."""
    return F.conv(F.substring(hash_hex(key, salt), 1, 8), 16, 10).cast("bigint")


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds or replaces columns so that each is evaluated once per row, however often it is used later.

    A plain ``withColumn`` is copied into every filter and projection that mentions it; long regular
    expression chains then run many times and outgrow the code generator. Filters on the new columns do
    not move below the one-row generator used here; filters on other columns still do. The columns are
    computed even when nothing reads them, so this belongs right before a filter that does.
    """
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
