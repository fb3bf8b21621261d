"""Splitting documents into sections and chunks. Every function maps a text column to an array column: no shuffle.

Null texts give null arrays, which ``posexplode`` drops; empty and blank texts give empty arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, strip

_HEAD = rf"(?:(?!\n){WS})*#{{2,3}} [^\n]*[^{WS[1:-1]}]"
_CHUNKS = "struct<done:array<string>,cur:string>"


def is_wiki_like(dataset: str, subset: str) -> bool:
    """Whether sections with Markdown headings are to be expected."""
    return subset.lower() == "wikipedia" if subset else "wikipedia" in dataset.lower()


def sections(text: Column) -> Column:
    """array<struct<heading, body>>: a line that starts with two or three number signs and a blank opens a section. The
    part before the first heading has the heading "". Sections without a body are left out."""
    parts = F.split(text, rf"\n(?={_HEAD})", -1)

    def one(p: Column) -> Column:
        has = p.rlike(rf"\A{_HEAD}")
        first = F.regexp_extract(p, r"\A([^\n]*)", 1)
        heading = strip(F.regexp_replace(strip(first), r"\A#+", ""))
        body = F.when(has, F.regexp_replace(p, r"\A[^\n]*\n?", "")).otherwise(p)
        return F.struct(F.when(has, heading).otherwise(F.lit("")).alias("heading"), strip(body).alias("body"))

    return F.filter(F.transform(parts, one), lambda s: s["body"] != "")


def sentences(text: Column) -> Column:
    """Sentences: cut at white space after . ! or ?"""
    return F.filter(F.split(strip(text), rf"(?<=[.!?]){WS}+", -1), lambda s: strip(s) != "")


def merged(blocks: Column, max_chars: int, joiner: Column) -> Column:
    """Consecutive blocks joined as long as the result has at most ``max_chars`` characters; a longer block stands alone."""
    def flush(s: Column) -> Column:
        return F.when(s["cur"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["cur"])))

    def step(s: Column, b: Column) -> Column:
        fits = F.length(s["cur"]) + F.length(joiner) + F.length(b) <= max_chars
        whole = F.concat(flush(s), F.array(b))
        return (
            F.when(F.length(b) > max_chars, F.struct(whole.alias("done"), F.lit("").alias("cur")))
            .when(s["cur"] == "", F.struct(s["done"].alias("done"), b.alias("cur")))
            .when(fits, F.struct(s["done"].alias("done"), F.concat(s["cur"], joiner, b).alias("cur")))
            .otherwise(F.struct(flush(s).alias("done"), b.alias("cur")))
        )

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))
    return F.aggregate(blocks, start, step, flush)


def pieces(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(text, pattern, -1), strip), lambda b: b != "")


def _finer(text: Column, by_blank: Column, max_chars: int) -> Column:
    """Blank-line blocks; if there is at most one and the text is too long, lines; if still at most one, sentences."""
    by_line = pieces(text, "\n")
    return F.when((F.length(text) <= max_chars) | (F.size(by_blank) > 1), by_blank).when(F.size(by_line) > 1, by_line).otherwise(sentences(text))


def _joiner(b: Column) -> Column:
    """A blank if the first of several blocks has no line end in it, else a line end."""
    first = F.coalesce(F.try_element_at(b, F.lit(1)), F.lit(""))
    return F.when((F.size(b) > 1) & ~first.contains("\n"), F.lit(" ")).otherwise(F.lit("\n"))


def with_chunks(df: DataFrame, text: str, max_chars: int = 3000, name: str = "_chunks") -> DataFrame:
    """Adds the chunks of a plain text. Each step is a column of its own: an array that an expression names twice would be
    computed twice, and inside the fold once for each block."""
    d = df.withColumn("_b1", pieces(F.col(text), rf"\n{WS}*\n"))
    d = d.withColumn("_b", _finer(F.col(text), F.col("_b1"), max_chars)).withColumn("_j", _joiner(F.col("_b")))
    return d.withColumn(name, merged(F.col("_b"), max_chars, F.col("_j"))).drop("_b1", "_b", "_j")


def exploded(df: DataFrame, array: str, pos: str, name: str) -> DataFrame:
    """One row for each element. The outer form with a filter on the position: for the inner form the optimizer adds a test
    of the array's size and pushes it to the scan, where the whole expression is then computed a second time."""
    return df.select("*", F.posexplode_outer(array).alias(pos, name)).where(F.col(pos).isNotNull()).drop(array)


def explode_parts(docs: DataFrame, text: str, wiki: bool, max_chars: int = 3000) -> DataFrame:
    """One row for each section (wiki) or chunk: adds ``chunk_idx``, ``section_heading`` and ``paragraph``."""
    if wiki:
        d = exploded(docs.withColumn("_sections", sections(F.col(text))), "_sections", "chunk_idx", "_part")
        return d.select("*", F.col("_part.heading").alias("section_heading"), F.col("_part.body").alias("paragraph")).drop("_part")
    return exploded(with_chunks(docs, text, max_chars), "_chunks", "chunk_idx", "paragraph").withColumn("section_heading", F.lit(""))
