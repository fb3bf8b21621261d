"""Column helpers with the white-space and word semantics of Unicode text, the same in every engine.

Java's ``\\s``, ``\\w`` and ``$`` differ from the Unicode classes, so classes are spelled out here. All helpers are built-in
expressions; ratios are compared by integer multiplication, which is exact and never divides by zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space: the Unicode property together with the separators U+001C to U+001F.
WS = r"[\s\x0B\x1C-\x1F\x85\xA0  -     　]"
#: The same in RE2 syntax, for SQL.
WS_SQL = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A letter, number or underscore.
WORD = r"[\p{L}\p{N}_]"


#: The same characters as a list, for trimming.
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without white space at both ends (only the ends are looked at)."""
    return F.btrim(c, F.lit(WS_CHARS))


def split_words(c: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(c, WS + "+", -1), lambda x: x != "")


def split_lines(c: Column) -> Column:
    """Lines that are not blank, stripped."""
    return F.filter(F.transform(F.split(c, "\n", -1), strip), lambda x: x != "")


def squeezed(c: Column) -> Column:
    """Words joined by one blank."""
    return F.array_join(split_words(c), " ")


def count_if(a: Column, test) -> Column:
    """Number of elements that pass ``test``."""
    return F.size(F.filter(a, test))


def matched_chars(c: Column, pattern: str) -> Column:
    """Characters in all matches of a pattern (without groups of its own)."""
    return F.aggregate(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)), F.lit(0), lambda a, x: a + F.length(x))


def member(values: list[str] | tuple[str, ...]):
    """Test of membership in a fixed list, for use in lambdas."""
    have = F.array(*[F.lit(v) for v in values])
    return lambda x: F.array_contains(have, x)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds (or replaces) columns that are computed exactly once. A filter on what is derived from a column is pushed below
    it with the column's whole expression put in, as often as it is named; it does not pass a generator, so
    the columns come out of one that makes a single row."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
