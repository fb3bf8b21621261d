"""Problem 6: token budget by source, language and domain, and the token sizes other operators need.

Method: each value is hashed, redelivered rows are dropped by key, each distinct text is tokenised once, its exact count is
joined back to the keys that hold it, and totals are summed by source, language and domain.

Only one row of each distinct text carries the text into Python; hashes and counts are what is shuffled. A text that a
third of all rows repeats is combined on the map side, and joins its size as one row for each slice.
Null and empty texts have 0 tokens. Token counts are exact for any text.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, materialise, path_of, plain_lang, plain_source

#: Path of the vocabulary file (a parameter: session setting ``corpusforge.tokenizer``).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same split for texts of usual letters only, where the classes of the standard library agree with it.
_FAST = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
_UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-ÿ\\u00a0«»–—‘’“”„…•·§]")
CACHE = 200_000

_encoders: dict[str, object] = {}
_pieces: dict[str, dict[str, int]] = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once in each Python worker."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        _pieces[path] = {}
    return _encoders[path]


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    """Exact number of tokens. Pieces between merges recur, so their counts are kept (at most CACHE of them)."""
    if not text:
        return 0
    enc = encoder(path)
    if _UNUSUAL.search(text):
        return len(enc.encode_ordinary(text))
    known = _pieces[path]
    parts = _FAST.findall(text)
    try:
        return sum(map(known.__getitem__, parts))
    except KeyError:
        pass
    if len(known) > CACHE:
        known.clear()
    n = 0
    for p in parts:
        k = known.get(p)
        if k is None:
            k = known[p] = len(enc.encode_ordinary(p))
        n += k
    return n


def vocabulary_path(spark: SparkSession) -> str:
    return path_of(spark, "corpusforge.tokenizer", VOCABULARY)


def text_hash(c: Column) -> list[Column]:
    """128 bits of a text in two columns."""
    return [F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(1), c, F.length(c)).alias("h2")]


def distinct_sizes(docs: DataFrame, text: str, path: str) -> DataFrame:
    """(h1, h2, copies, tokens, chars): one row for each distinct text that is not null. The text itself is aggregated with
    ``first`` on the map side, so each map task sends a distinct text once at most."""
    one = docs.where(F.col(text).isNotNull()).select(*text_hash(F.col(text)), F.col(text).alias("text")).groupBy("h1", "h2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return map_rows(one, ["h1", "h2", "copies"], ["text"], lambda t: (count_tokens(t, path), len(t)), "tokens long, chars long")


def sizes(docs: DataFrame, key: str, text: str, keep: list[str], path: str) -> DataFrame:
    """(key, keep..., tokens) for each row, a narrow map without any shuffle; null texts have 0 tokens."""
    return map_rows(docs, [key, *keep], [text], lambda t: (count_tokens(t, path),), "tokens long")


SALTS = 4


def counted(docs: DataFrame, key: str, text: str, keep: list[Column], path: str) -> DataFrame:
    """(key, keep..., tokens, chars, copies) for each distinct key (null keys stay out). Each distinct text is tokenised once
    and its count joined back; the join is salted by key, so that a text that many rows hold is no single task's work.
    ``copies`` is the number of rows with that text."""
    rows = docs.where(F.col(key).isNotNull()).select(key, *text_hash(F.coalesce(F.col(text), F.lit(""))), *keep).dropDuplicates([key])
    size = distinct_sizes(docs, text, path).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    j = rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(size, ["h1", "h2", "salt"], "left").drop("salt", "h1", "h2")
    return j.na.fill(0, ["tokens", "chars", "copies"])


def with_slice_totals(counted_rows: DataFrame, key: str) -> DataFrame:
    """Adds ``slice_passages`` and ``slice_tokens``, the totals of the row's source, language and domain. The counts (no text) are
    written once; a slice that holds a third of all rows meets its total in a salted join."""
    t = materialise(counted_rows, "token-counts")
    by = ["source", "lang", "domain"]
    total = t.groupBy(*by).agg(F.count("*").alias("slice_passages"), F.sum("tokens").alias("slice_tokens")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return t.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(total, [*by, "salt"]).select(*t.columns, "slice_passages", "slice_tokens")


def domain(url: Column) -> Column:
    """Host of a URL in lower case without port; null, blank, ``None`` or no URL is ``unknown``."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@\s]*@)?([^/:?#\s]+)", 1))
    return F.when(F.coalesce(host, F.lit("")) == "", F.lit("unknown")).otherwise(host)


def slices(source: str = "source_type", lang: str = "lang", url: str = "url") -> list[Column]:
    return [plain_source(F.col(source), "knowledge").alias("source"), plain_lang(F.col(lang)).alias("lang"), domain(F.col(url)).alias("domain")]


def budget(docs: DataFrame, key: str = "selected_id", text: str = "paragraph", path: str = VOCABULARY, source: str = "source_type", lang: str = "lang", url: str = "url") -> DataFrame:
    """The operator: (source, lang, domain, passages, distinct_texts, tokens, distinct_tokens, chars, level). ``tokens``
    counts each passage once; ``distinct_tokens`` each distinct text once within the slice. ``level`` is ``slice`` for the
    finest rows; totals by source, by language, by domain and overall follow, with ``*`` for what is summed over."""
    keep = slices(source, lang, url)
    empty = F.coalesce(F.col(text), F.lit(""))
    rows = docs.where(F.col(key).isNotNull()).select(key, *text_hash(empty), *keep).dropDuplicates([key])
    # a text's multiplicity in a slice is one row before it meets its size, so a text that many rows repeat is no hot key
    n = rows.groupBy("source", "lang", "domain", "h1", "h2").agg(F.count("*").alias("n"))
    size = distinct_sizes(docs, text, path)
    m = n.join(size, ["h1", "h2"], "left").select("source", "lang", "domain", "h1", "h2", "n", F.coalesce("tokens", F.lit(0)).alias("t"), F.coalesce("chars", F.lit(0)).alias("c"))
    m = m.groupingSets([["source", "lang", "domain", "h1", "h2"], ["source", "h1", "h2"], ["lang", "h1", "h2"], ["domain", "h1", "h2"], ["h1", "h2"]], "source", "lang", "domain", "h1", "h2").agg(
        F.sum("n").alias("n"), F.max("t").alias("t"), F.max("c").alias("c"), F.grouping_id().alias("g")
    )
    level = F.create_map(*[F.lit(x) for kv in ((0, "slice"), (12, "source"), (20, "lang"), (24, "domain"), (28, "all")) for x in kv])
    fill = lambda c, bit: F.when(F.col("g").bitwiseAND(bit) != 0, F.lit("*")).otherwise(F.col(c)).alias(c)
    t = m.select(fill("source", 16), fill("lang", 8), fill("domain", 4), level[F.col("g").cast("int")].alias("level"), "n", "t", "c")
    return t.groupBy("source", "lang", "domain", "level").agg(
        F.sum("n").alias("passages"), F.count("*").alias("distinct_texts"), F.sum(F.col("n") * F.col("t")).alias("tokens"), F.sum("t").alias("distinct_tokens"), F.sum(F.col("n") * F.col("c")).alias("chars")
    )
