"""Source types, prompt formats, rendering, and the checks of generated instructions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import WS, count_if, member, split_words, strip


def _lookup(mapping: dict[str, str], key: Column, default: str) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[key], F.lit(default))


def source_type(subset: Column) -> Column:
    """Source type of a subset; an unknown or null one is ``knowledge``."""
    return _lookup(fixed.SUBSET_TYPES, subset, fixed.DEFAULT_TYPE)


def format_choice(text: Column) -> Column:
    """A, B or C by the SHA-256 of the text modulo 3. As 16 is 1 modulo 3, the sum of the hex digits has the same remainder."""
    digits = F.split(F.sha2(text.cast("binary"), 256), "")
    total = F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0), lambda a, d: a + F.conv(d, 16, 10).cast("int"))
    return F.element_at(F.array(*[F.lit(f) for f in fixed.FORMATS]), (total % 3) + 1)


def rendered(templates: dict[str, str], key: Column, default: str, text: Column) -> Column:
    """The template of ``key`` with ``{paragraph}`` replaced; braces of the text mean nothing."""
    return F.replace(_lookup(templates, key, templates[default]), F.lit("{paragraph}"), text)


def without_label(c: Column) -> Column:
    """Without a format label the model repeated, on the line or above it."""
    c = strip(F.regexp_replace(strip(c), rf"\AFormat{WS}+[A-C]{WS}*[-:—]{WS}*", ""))
    return strip(F.regexp_replace(c, rf"\AFormat{WS}+[A-C]{WS}*\n+", ""))


def looks_danish(c: Column) -> Column:
    """At least 6 % of the words mark Danish; under eight words always. Words are not stripped of signs."""
    w = split_words(F.lower(c))
    return (F.size(w) < 8) | (count_if(w, member(fixed.DANISH_MARKERS)) * 100 >= F.size(w) * 6)


def select_verdict(response: Column, verbatim: Column, least: int = 150) -> Column:
    """fail, skip, short, verify or kept, in this order."""
    r = strip(F.coalesce(response, F.lit("")))
    return F.when(F.coalesce(response, F.lit("")) == "", "fail").when(F.upper(r) == "SKIP", "skip").when(F.length(r) < least, "short").when(~verbatim, "verify").otherwise("kept")


def usable(instruction: Column, answer: Column) -> Column:
    """Both there, and the instruction does not start as a refusal does."""
    i, a = F.coalesce(instruction, F.lit("")), F.coalesce(answer, F.lit(""))
    refused = F.lit(False)
    for p in fixed.REFUSAL_STARTS:
        refused = refused | i.startswith(p)
    return (i != "") & (a != "") & ~refused


def chat(instruction: Column, answer: Column) -> Column:
    """The two messages of a training record: array<struct<content, role>>."""
    m = lambda c, r: F.struct(c.alias("content"), F.lit(r).alias("role"))
    return F.array(m(instruction, "user"), m(answer, "assistant"))
