"""The catalogue of text-quality rules as boolean columns (true: rejected), and the verdict of the first that fails.

Each rule is a built-in expression. What concerns words is counted by regular expressions over the whole text, which stay
in generated code; a lambda over an array of words would be interpreted word by word. Rules that few texts come near to
look at the words only where one search of the text says that there may be something. ``with_parts`` computes once
what several rules read. A null text is rejected as too short.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import WORD, WS, WS_CHARS, count_if, matched_chars, once, split_lines

_INNER = WS[1:-1]


def _class(signs: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in signs)


def _bare(core: str, signs: str) -> str:
    """In a text whose words stand between blanks: a word that is ``core`` once the signs at its ends are off."""
    return rf" [{_class(signs)}]*+{core}[{_class(signs)}]*+(?= )"


def text() -> Column:
    return F.col("paragraph")


def flat() -> Column:
    return F.col("_flat")


def n_words() -> Column:
    return F.col("_n_words")


def lines() -> Column:
    return F.col("_lines")


def with_parts(df: DataFrame, column: str = "paragraph") -> DataFrame:
    """Adds what the rules read: ``_flat`` (lower case, each white-space character a blank, a blank at both ends), ``_n_words``
    and ``_lines``; and ``paragraph``, if the text has another name. Null reads as ""."""
    t = F.coalesce(F.col(column), F.lit(""))
    flat_text = F.concat(F.lit(" "), F.lower(F.translate(t, WS_CHARS, " " * len(WS_CHARS))), F.lit(" "))
    d = once(df, paragraph=t, _flat=flat_text, _lines=split_lines(t))
    return once(d, _n_words=counted(flat(), "[^ ]+"))


def counted(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def heading() -> Column:
    """The section's heading is one of those without running text."""
    return F.lower(F.coalesce(F.col("section_heading"), F.lit(""))).isin(*fixed.SKIPPED_HEADINGS)


def length(min_chars: int = 100, max_chars: int = 3000) -> Column:
    return ~F.length(text()).between(min_chars, max_chars)


def mostly_list() -> Column:
    """More than half of the lines are list items or table rows, or there is no line."""
    starts = lambda l: F.substring(l, 1, 2).isin(*fixed.LIST_STARTS)
    return (F.size(lines()) == 0) | (count_if(lines(), starts) * 2 > F.size(lines()))


def links() -> Column:
    """More than 40 % of the characters are Markdown links, or there is no character."""
    return (F.length(text()) == 0) | (matched_chars(text(), r"(?d)\[.*?\]\(.*?\)") * 10 > F.length(text()) * 4)


def stub() -> Column:
    t = F.lower(text())
    return t.contains("stub") & (t.contains("denne artikel") | t.contains("denne side"))


def years() -> Column:
    """Of 20 words or more, more than one in 30 is a year from 1000 to 2099 (ASCII digits)."""
    year = r" \(?(?:1[0-9]|20)[0-9]{2}[).,;:-]*+(?= )"
    return (n_words() >= 20) & (counted(flat(), year) * 30 > n_words())


def few_sentences(least: int = 3) -> Column:
    return count_if(F.split(F.trim(flat()), r"[.!?](?: |\z)", -1), lambda s: F.trim(s) != "") < least


def foreign_script() -> Column:
    ranges = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in fixed.FOREIGN_SCRIPTS)
    usual = f"\\x00-\\x{{{min(a for a, _ in fixed.FOREIGN_SCRIPTS) - 1:X}}}\\x{{2010}}-\\x{{2FFF}}"  # one look for anything else
    return text().rlike(f"[^{usual}]") & text().rlike(f"[{ranges}]")


def doubled() -> Column:
    """Two words or more with a run of two to four characters doubled, words that may have one left out."""
    legit = [w for w in fixed.DOUBLED_ALLOWED if re.search(r"(\w{2,4})\1", w)]
    found = counted(flat(), rf"({WORD}{{2,4}})\1[^ ]*+")
    return F.when(found >= 2, found - counted(flat(), _bare(f"(?:{'|'.join(legit)})", fixed.WORD_SIGNS)) >= 2).otherwise(F.lit(False))


def stray() -> Column:
    """Of more than 10 words, more than 5 % are clusters of one to three characters without a vowel."""
    inner, end = f"[^ {fixed.VOWELS}]", f"[^ {fixed.VOWELS}{_class(fixed.WORD_SIGNS_LONG)}]"
    cluster = _bare(f"{end}(?:{inner}?{end})?", fixed.WORD_SIGNS_LONG)
    return (n_words() > 10) & (counted(flat(), cluster) * 20 > n_words())


def corrupted() -> Column:
    return foreign_script() | doubled() | stray()


def quotes() -> Column:
    """More than 40 % of the lines start as speech, or of the characters stand in quotation marks; or there is no line."""
    start = lambda l: F.substring(l, 1, 2).isin(*[s for s in fixed.SPEECH_STARTS if len(s) == 2]) | F.substring(l, 1, 1).isin(*[s for s in fixed.SPEECH_STARTS if len(s) == 1])
    opened = "".join(dict.fromkeys(a for a, _ in fixed.QUOTE_PAIRS))
    inside = sum((matched_chars(text(), f"{a}[^{b}]{{2,}}{b}") for a, b in fixed.QUOTE_PAIRS), F.lit(0))
    quoted = F.when(text().rlike(f"[{opened}]"), inside * 10 > F.length(text()) * 4).otherwise(F.lit(False))
    return (F.size(lines()) == 0) | (count_if(lines(), start) * 10 > F.size(lines()) * 4) | quoted


def boilerplate() -> Column:
    """Of three lines or more, over 60 % are under eight words and do not end as a sentence does."""
    eight = rf"\A(?:[^{_INNER}]++[{_INNER}]++){{7}}[^{_INNER}]"
    short = lambda l: ~l.rlike(r"[.!?:]\z") & ~l.rlike(eight)
    return (F.size(lines()) >= 3) & (count_if(lines(), short) * 10 > F.size(lines()) * 6)


def old_spelling() -> Column:
    """Of 20 words or more, over 2 % have aa (place names apart) or over 1 % are words of the old spelling."""
    of = lambda values: _bare(f"(?:{'|'.join(map(re.escape, values))})", fixed.WORD_SIGNS_LONG)
    aa = F.when(flat().contains("aa"), counted(flat(), "aa[^ ]*+") - counted(flat(), of(fixed.AA_PLACES))).otherwise(F.lit(0))
    return (n_words() >= 20) & ((aa * 50 > n_words()) | (counted(flat(), of(fixed.OLD_WORDS)) * 100 > n_words()))


def rules(wiki: bool, min_chars: int = 100, max_chars: int = 3000) -> list[tuple[str, Column]]:
    """Names and rules in the order they are tried: cheap ones first."""
    r = [("length", length(min_chars, max_chars)), ("list", mostly_list()), ("links", links())]
    if wiki:
        r = [("heading", heading()), *r, ("stub", stub())]
    return [*r, ("years", years()), ("sentences", few_sentences()), ("corrupted", corrupted()), ("quotes", quotes()), ("boilerplate", boilerplate()), ("old_spelling", old_spelling())]


def verdict(wiki: bool, min_chars: int = 100, max_chars: int = 3000) -> Column:
    """Name of the first rule that fails, else ``kept``. One CASE: later rules are not evaluated for rejected rows."""
    v = None
    for name, rule in rules(wiki, min_chars, max_chars):
        v = F.when(rule, name) if v is None else v.when(rule, name)
    return v.otherwise("kept")


def judged(df: DataFrame, wiki: bool, column: str = "paragraph", min_chars: int = 100, max_chars: int = 3000) -> DataFrame:
    """Adds ``verdict``."""
    return with_parts(df, column).withColumn("verdict", verdict(wiki, min_chars, max_chars)).drop("_flat", "_n_words", "_lines")
