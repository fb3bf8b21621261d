"""Problem 9: reading level of each document.

Method: words of each language are ranked by frequency (words of one frequency share a rank); a coverage rank of a document
is the size of the smallest frequency-ranked vocabulary of its language that covers a fixed share of its tokens. Coverage
ranks at two shares and sentence complexity (length, nesting, shares of long and of short words) are calibrated in SQL: an
ordinary least squares fit to the readers' grades, of which only the sums of products (one row) reach the driver. The
calibrated grade alone tells easy, ordinary and hard running text apart.

Word counts are combined in each Arrow batch before they are shuffled. The most frequent words of each language, at most
TOP of them, are broadcast (a fixed bound), which settles every document whose shares they cover; the rest of the documents
join the ranks of their other words by shuffle, so that every coverage rank is exact.

Null and empty documents have 0 words, no coverage rank and the level ``none``. A repeated key counts once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _MASK, ABBREVIATIONS, END, WORD, guess_language, materialise

#: Shares of a document's tokens that its vocabulary has to cover: the core, and what a fluent reader meets.
SHARES = (0.5, 0.8)
#: Words of each language that are broadcast.
TOP = 20_000
#: Frequencies up to this number are broadcast (16 bytes each); more meet the words in a join salted by word.
FEW_FREQUENCIES, SALTS = 200_000, 64
#: Grades from which a text is easy or hard on the readers' scale of 1 to 10.
EASY_TO, HARD_FROM = 3.7, 7.1
MIN_WORDS = 12

_ENTRY = re.compile(r"\s*(?:[-–—*•·+|]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])\s+")
_HEAD = re.compile(r"^\s*#{1,6}\s")
#: A speaker label before a line is no part of its sentence.
_LABEL = re.compile(r"^\s*[A-ZÆØÅÄÖÜ]{3,}(?: \d+)?:\s+")
_ODD = re.compile(r"(?<=[^\W\d_])[^\w\s'’\-/](?=[^\W\d_])|[\^|=<>{}\[\]\\_~]|\d(?=[^\W\d_])|(?<=[a-zæøåäöü])[A-ZÆØÅ]")


_CAMEL = re.compile(r"[a-zæøåäöü][A-ZÆØÅ]")
_common = frozenset(_MASK).__contains__


def word_list(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _sentence_sizes(line: str) -> list[int]:
    """Words between white space of each sentence of a line."""
    out, at = [], 0
    for m in END.finditer(line):
        if m.group()[0] == ".":
            tail = line[max(at, m.start() - 20):m.start()].rsplit(None, 1)
            w = tail[-1].rsplit(".", 1)[-1].lstrip("([»«\"“„'").lower() if tail else ""
            if w in ABBREVIATIONS or len(w) == 1 and w.isalpha() or w.isdigit() and line[m.end():m.end() + 2].strip()[:1].islower():
                continue
        out.append(len(line[at:m.end()].split()))
        at = m.end()
    if at < len(line) - 1:
        out.append(len(line[at:].split()))
    return [n for n in out if n]


def _is_odd(line: str, letters: int) -> bool:
    """More than a twelfth of the line is signs inside words and the like. Each of them is a sign, or a capital inside a word."""
    signs = len(line) - letters - line.count(" ")
    return (signs * 12 > len(line) or _CAMEL.search(line) is not None) and len(_ODD.findall(line)) * 12 > len(line)


def features(text: str | None) -> tuple:
    """Figures of one text, see ``measured``."""
    return measured(text)[0]


def measured(text: str | None) -> tuple[tuple, list[str]]:
    """The figures of one text and its words. The figures: (words, prose_words, sentences, mean_sentence, long_sentence, mean_word, long_share, short_share, commas, prose_share)
    of one text. Only running text counts: lines that are entries, headings, cells or noise are left out of all but ``words``.
    ``long_sentence`` is the 90th percentile of the words in a sentence, each sentence once."""
    if not text:
        return (0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), []
    total = 0
    everything: list[str] = []
    lens: list[int] = []
    by_size: Counter[int] = Counter()
    commas = chars = prose = 0
    for line in text.split("\n"):
        if not line or line.isspace():
            continue
        n_all = line.count(" ") + 1
        total += n_all
        low = WORD.findall(line.lower())
        everything += low
        if ":" in line[:40] and _LABEL.match(line):
            line = _LABEL.sub("", line)
            low = low[1:]
        chars += len(line)
        if len(low) < 2 or "\t" in line or "   " in line or line.count("|") >= 2 or line.count(";") * 5 >= n_all and line.count(";") >= 2 or _ENTRY.match(line) or _HEAD.match(line):
            continue
        sizes = Counter(map(len, low))
        if _is_odd(line, sum(s * n for s, n in sizes.items())):
            continue
        common = sum(map(_common, low))
        ended = line.rstrip(" \"'»«”“’)")[-1:] in ".!?…"
        if not ended and (len(low) > 14 or not common) and common * 5 < len(low):
            continue
        if common * 12 < len(low) and len(low) > 6:
            continue
        prose += len(line)
        by_size.update(sizes)
        commas += line.count(",")
        lens += _sentence_sizes(line)
    words = by_size.total()
    if not words or not lens:
        return (total, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), everything
    lens.sort()
    letters = longw = shortw = 0
    for s, n in by_size.items():
        letters += s * n
        if s >= 10:
            longw += n
        elif s <= 5:
            shortw += n
    return (total, words, len(lens), words / len(lens), float(lens[min(len(lens) - 1, len(lens) * 9 // 10)]), letters / words, longw / words, shortw / words, commas / len(lens), prose / chars), everything


FEATURES = "words int, prose_words int, sentences int, mean_sentence double, long_sentence double, mean_word double, long_share double, short_share double, commas double, prose_share double"


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(lang, word, n) of the corpus, the language guessed for each document. Each batch is counted before rows are made of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, Counter[str]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, c in by.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], names=["lang", "word", "n"])
            by.clear()

        for b in batches:
            for t in b.column(0).to_pylist():
                words = word_list(t)
                by.setdefault(guess_language(words), Counter()).update(words)
            if sum(map(len, by.values())) > 200_000:
                yield from rows()
        yield from rows()

    return docs.select(text).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_ranks(counts: DataFrame) -> DataFrame:
    """(lang, word, n, rank): the number of words of the language at least as frequent. Ranks come from the histogram of
    frequencies, whose rows are the different frequencies only. They are summed in two steps, within blocks of frequencies
    (powers of two) and over the blocks, so that no task holds more than a block."""
    hist = materialise(counts.groupBy("lang", "n").agg(F.count("*").alias("words")).withColumn("block", F.floor(F.log2("n")).cast("int")), "frequencies")
    inner = hist.withColumn("within", F.sum("words").over(W.partitionBy("lang", "block").orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0)))
    blocks = hist.groupBy("lang", "block").agg(F.sum("words").alias("all"))  # 64 rows a language at most
    above = blocks.select("lang", "block", F.coalesce(F.sum("all").over(W.partitionBy("lang").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("above"))
    ranked = inner.join(F.broadcast(above), ["lang", "block"]).select("lang", "n", (F.col("within") + F.col("above")).alias("rank"))
    ranked = materialise(ranked, "rank-histogram")
    if ranked.limit(FEW_FREQUENCIES + 1).count() <= FEW_FREQUENCIES:
        return counts.join(F.broadcast(ranked), ["lang", "n"]).select("lang", "word", "n", "rank")
    wide = ranked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # half of all words occur once
    return counts.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")).join(wide, ["lang", "n", "salt"]).select("lang", "word", "n", "rank")


def top_words(ranks: DataFrame, top: int = TOP) -> dict[str, dict[str, int]]:
    """The words of rank ``top`` or less by language: ``top`` words of each of five at most, as a frequency is in whole or not
    at all."""
    out: dict[str, dict[str, int]] = {}
    for r in ranks.where(F.col("rank") <= top).select("lang", "word", "rank").collect():
        out.setdefault(r.lang, {})[r.word] = r.rank
    return out


def coverage(rank_counts: dict[int, int], total: int, share: float) -> int | None:
    """Least rank whose vocabulary covers ``share`` of ``total`` tokens; None if these ranks do not reach it."""
    need = math.ceil(share * total - 1e-9)
    run = 0
    for r in sorted(rank_counts):
        run += rank_counts[r]
        if run >= need:
            return r
    return None


def coverages(rank_counts: dict[int, int], total: int, shares: tuple[float, ...]) -> list[int | None]:
    """``coverage`` at ascending shares, in one pass."""
    out, run, k = [], 0, 0
    need = [math.ceil(s * total - 1e-9) for s in shares]
    for r in sorted(rank_counts):
        run += rank_counts[r]
        while k < len(need) and run >= need[k]:
            out.append(r)
            k += 1
        if k == len(need):
            break
    return out + [None] * (len(need) - len(out))


NAMES = [c.split()[0] for c in FEATURES.split(", ")]
#: Columns of the coverage ranks.
COVERS = [f"cover{round(100 * s)}" for s in SHARES]


def _profiles(docs: DataFrame, key: str, text: str, top: dict[str, dict[str, int]], shares: tuple[float, ...]) -> DataFrame:
    """Features, the coverage ranks where the broadcast words settle them, and else the document's other words."""
    sc = docs.sparkSession.sparkContext
    ranks = sc.broadcast(top)
    types = [pa.int32() if c.endswith(" int") else pa.float64() for c in FEATURES.split(", ")]
    pair = pa.list_(pa.struct([("rank", pa.int64()), ("n", pa.int32())]))
    rare = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))
    covers = [f"cover{round(100 * s)}" for s in shares]
    types += [pa.string(), *[pa.int64()] * len(shares), pa.int32(), pair, rare]

    def one(t: str | None) -> tuple:
        f, low = measured(t)
        lang = guess_language(low)
        if not low:
            return (*f, lang, *[None] * len(shares), 0, None, None)
        rank_of = ranks.value.get(lang, {})
        got = Counter(map(rank_of.get, low))
        got.pop(None, 0)
        cover = coverages(got, len(low), shares)
        if cover[-1] is not None:
            return (*f, lang, *cover, len(low), None, None)
        known = [{"rank": r, "n": n} for r, n in got.items()]
        other = [{"word": w, "n": n} for w, n in Counter(w for w in low if w not in rank_of).items()]
        return (*f, lang, *[None] * len(shares), len(low), known, other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*[one(t) for t in b.column(1).to_pylist()])) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(list(c), ty) for c, ty in zip(cols, types)], names=[key, *NAMES, "lang", *covers, "tokens", "known", "other"])

    kind = docs.schema[key].dataType.simpleString()
    more = ", ".join(f"{c} long" for c in covers)
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {FEATURES}, lang string, {more}, tokens int, known array<struct<rank:long,n:int>>, other array<struct<word:string,n:int>>")


def profiles(docs: DataFrame, key: str = "doc_id", text: str = "text", shares: tuple[float, ...] = SHARES, top: int = TOP) -> DataFrame:
    """(key, FEATURES, lang, tokens, a coverage rank for each of ``shares``) for each distinct key."""
    d = docs.where(F.col(key).isNotNull())
    covers = [f"cover{round(100 * s)}" for s in shares]
    ranks = materialise(word_ranks(materialise(word_counts(d, text), "words")), "word-ranks")
    p = materialise(_profiles(d, key, text, top_words(ranks, top), shares), "reading")
    # of the rows of a redelivered key one is left; nothing but figures is shuffled
    settled, unsettled = p.where(f"{covers[-1]} is not null or tokens = 0"), p.where(f"{covers[-1]} is null and tokens > 0")
    done = settled.select(key, *NAMES, "lang", "tokens", *covers)
    # documents whose shares the broadcast words do not cover: their other words meet the ranks by shuffle
    open_ = unsettled.dropDuplicates([key])
    words = open_.select(key, "lang", F.explode("other").alias("o")).select(key, "lang", "o.word", "o.n").join(ranks.select("lang", "word", "rank"), ["lang", "word"]).select(key, "rank", "n")
    both = words.unionByName(open_.select(key, F.explode("known").alias("o")).select(key, "o.rank", "o.n")).groupBy(key, "rank").agg(F.sum("n").alias("n"))
    run = F.sum("n").over(W.partitionBy(key).orderBy("rank"))  # one document's words
    full = both.withColumn("run", run).join(open_.select(key, "tokens"), key)
    cover = full.groupBy(key).agg(*[F.min(F.when(F.col("run") >= F.ceil(F.col("tokens") * F.lit(s) - F.lit(1e-9)), F.col("rank"))).alias(c) for s, c in zip(shares, covers)])
    late = open_.drop(*covers).join(cover, key, "left").select(key, *NAMES, "lang", "tokens", *covers)
    return done.unionByName(late).dropDuplicates([key])


#: Regressors of the calibration; each is a SQL expression over a profile.
TERMS = {
    "one": "1.0d", "core": f"ln(1 + coalesce({COVERS[0]}, 0))", "rank": f"ln(1 + coalesce({COVERS[1]}, 0))", "sentence": "ln(1 + mean_sentence)", "sentence2": "ln(1 + mean_sentence) * ln(1 + mean_sentence)",
    "nesting": "ln(1 + commas)", "learned": "long_share", "everyday": "short_share",
}


def calibrate(spark: SparkSession, p: DataFrame, grades: DataFrame, key: str = "doc_id") -> dict[str, float]:
    """Least squares of the median grade on TERMS, over all graded documents of running text. SQL forms the sums of products
    (one row); the driver solves as many equations as there are terms, with a small ridge. Repeated grade rows count once,
    null grades not."""
    g = grades.where("grade is not null").select(key, "rater", "grade", "rated_at").distinct().groupBy(key).agg(F.percentile("grade", 0.5).alias("y"))
    x = p.where(f"prose_words >= {MIN_WORDS} and prose_share >= 0.6").join(g, key).select(*[F.expr(e).alias(n) for n, e in TERMS.items()], F.col("y").cast("double").alias("y"))
    names = list(TERMS)
    sums = x.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in names for b in [*names, "y"]], F.count("*").alias("n")).first()
    if not sums or not sums["n"]:
        return {"one": 5.0, **dict.fromkeys(names[1:], 0.0)}
    import numpy as np

    A = np.array([[sums[f"{a}_{b}"] for b in names] for a in names]) + 1e-3 * np.diag([0.0, *[1.0] * (len(names) - 1)])
    y = np.array([sums[f"{a}_y"] for a in names])
    return dict(zip(names, map(float, np.linalg.lstsq(A, y, rcond=None)[0])))


def graded(p: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds ``grade`` (calibrated, 1 to 10) and ``level``: easy up to EASY_TO, hard from HARD_FROM, else ordinary; none for what
    is no running text."""
    total = sum((F.expr(e) * F.lit(weights[n]) for n, e in TERMS.items()), F.lit(0.0))
    running = (F.col("prose_words") >= MIN_WORDS) & (F.col("prose_share") >= 0.5)
    q = p.withColumn("grade", F.when(running, F.greatest(F.lit(1.0), F.least(F.lit(10.0), total))))
    return q.withColumn("level", F.when(~running, "none").when(F.col("grade") <= EASY_TO, "easy").when(F.col("grade") >= HARD_FROM, "hard").otherwise("ordinary"))


def reading_levels(docs: DataFrame, grades: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The operator: (key, FEATURES, lang, tokens, COVERS, grade, level)."""
    p = materialise(profiles(docs, key, text), "reading-profiles")
    return graded(p, calibrate(docs.sparkSession, p, grades, key))
