"""Problem 1: text quality statistics of each paragraph, and the verdict prose, list, table or junk.

Method: one Arrow pass gives each paragraph its statistics, which are kept as a narrow table. Mergeable KLL sketches are built
per language and merged into one for the whole corpus: of each statistic over the texts that are mainly sentences, and of
the share of sentences over all texts. From the sketches come
- the share from which a text is "mainly sentences" in its language: the emptiest place of the share's distribution around
  a half, so that the cut falls between the texts that are sentences and those that are not, wherever that is;
- the robust z-score of each value: its distance from the median of the language's sentence texts, in units of the spread
  between the median and the upper (or lower) decile. A decile is not moved by a tenth of strange texts, nor by any
  amount of lists, tables and junk, which are no sentence texts.
The tails are flagged, and the verdict is read from the cut and the flags. Only figures from the sketches (one row for each
of five languages, a fixed number) are broadcast.

Null and blank paragraphs have zero words, all shares 0, language ``und`` and the kind ``empty``.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _MASK, LANGS, WORD, language_scores, map_rows, materialise

#: Statistics that get sketches, with the least scale of a z-score (a spread can be 0: most texts have no cell at all).
STATS = {
    "mean_word_len": 0.4, "symbol_ratio": 0.01, "digit_ratio": 0.01, "end_line_share": 0.1, "common_share": 0.04, "sentence_share": 0.06, "distinct_share": 0.05, "cell_line_share": 0.1,
    "entry_line_share": 0.05, "longest_word": 3.0, "broken_share": 0.02, "pair_share": 0.03, "log_share": 0.1, "crumbs": 0.9, "flat_share": 0.12, "top_share": 0.03, "chars_a_word": 1.5,
}
TAIL = 3.0
#: A text counts as mainly sentences from this share of its characters on, as long as the sketches do not tell better.
MAINLY = 0.5
#: The cut is sought within this distance from MAINLY, in steps; a place is as empty as the share of texts within STEP of it.
REACH, STEP = 0.2, 0.05
#: Lower decile, median and upper decile of the prose of sf0.1, for a corpus that holds no prose at all.
ORDINARY = {
    "mean_word_len": (5.5, 5.91, 6.3), "symbol_ratio": (0.0, 0.0, 0.0), "digit_ratio": (0.0, 0.006, 0.02), "end_line_share": (0.6, 1.0, 1.0), "common_share": (0.34, 0.375, 0.41), "sentence_share": (0.92, 1.0, 1.0),
    "distinct_share": (0.66, 0.762, 0.85), "cell_line_share": (0.0, 0.0, 0.0), "entry_line_share": (0.0, 0.0, 0.25), "longest_word": (14.0, 16.0, 18.0), "broken_share": (0.0, 0.0, 0.004), "pair_share": (0.0, 0.06, 0.14),
    "log_share": (0.0, 0.0, 0.0), "crumbs": (0.0, 0.0, 0.0), "flat_share": (0.0, 0.0, 0.0), "top_share": (0.05, 0.06, 0.09), "chars_a_word": (6.4, 6.9, 7.5),
}

_TAG_CELL = re.compile(r"</t[dh]>\s*<t[dh][^>]*>|\s*\|\|\s*", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,200}>|<!--.*?-->", re.S)
_LI = re.compile(r"<li[^>]*>", re.I)
_BLOCK = re.compile(r"(?:</(?:li|tr|p|h[1-6]|div|table|ul|ol|pre)>|<br\s*/?>)(?![ \t]*(?-i:[a-zæøåäöü]))", re.I)  # a sentence that goes on is not broken
_MARK = re.compile(r"(?:[-–—*•·+]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|\\item\b|#)\s+")
_LOG = re.compile(r"\d{4}-\d\d-\d\d[T ]\d\d:\d\d|\d{1,2}:\d\d:\d\d[ ,.]|\[\d\d/|(?:INFO|WARN|ERR|ERROR|DEBUG)\b")
_GAP = re.compile(r"\S {2,}\S|\S\t+\S")
_KEYED = re.compile(r"\S+(?: \S+){0,3}: \S+(?: \S+){0,5}$")
_LAST = re.compile(r".*[.!?…][\"'»«”“’)\]]*(?=\s|$)", re.S)
_SIGNS = re.compile(r"[^\w\s]+")
_USUAL = frozenset(".,;:!?\"'()«»“”‘’„–—%§&/…|*•·>+=#-")
_INSIDE = re.compile(r"[^\W\d_A-ZÆØÅÄÖÜ][A-ZÆØÅÄÖÜ0-9][^\W_]")
_URL = re.compile(r"\S+://\S+|\S+@\S+")
_JSON = re.compile(r"\s*[\[{]\s*\"[^\"]{1,80}\"\s*:")
_CRUMB = re.compile(r"\s(?:»|>|›|→)\s")
_CLOSERS = "\"'»«”“’)]*_ "
_STOPS = frozenset(".!?…")
_DIGIT = re.compile(r"[0-9]")
_PARTED = re.compile(r"[,;|/·•»>]\s")


def plain_lines(text: str) -> list[str]:
    """Lines without tags: cells parted by tabs, list entries marked, blank lines left out."""
    if "<" in text:
        text = _TAG_CELL.sub("\t", text)
        text = _LI.sub("\n- ", text)
        text = _BLOCK.sub("\n", text)
        text = _TAG.sub(" ", text)
    elif "||" in text:
        text = _TAG_CELL.sub("\t", text)
    return [x for l in text.split("\n") if (x := l.strip())]


def signs(text: str) -> tuple[int, int]:
    """(unusual signs, broken places). Unusual: signs that text does not hold, in runs of three or more, or between letters.
    Broken: signs where none belong, before a word or inside it, and capitals or digits inside a word."""
    odd, broken = 0, len(_INSIDE.findall(text))
    for m in _SIGNS.finditer(text):
        s, e = m.span()
        g = m.group()
        a, b = text[s - 1] if s else "\n", text[e:e + 1]
        if e - s >= 3:
            odd += e - s
        elif not _USUAL.issuperset(g):
            odd += sum(c not in _USUAL for c in g)
        elif e - s == 1 and g not in "'’-/" and a.isalpha() and b.isalpha():
            odd += 1
        if "^" in g or "~" in g:
            broken += g.count("^") + g.count("~")
        elif g[0] in ",.:!?" and (a.isspace() or e - s == 1 and a.islower() and b.isalnum()):
            broken += 1
    return odd, broken


_common = frozenset(_MASK).__contains__


def _function_words(words: list[str]) -> int:
    return sum(map(_common, words))


NAMES = (
    "words", "chars", "lines", "lang", "mean_word_len", "symbol_ratio", "digit_ratio", "end_line_share", "common_share", "sentence_share", "distinct_share", "cell_line_share", "entry_line_share",
    "longest_word", "is_json", "log_share", "pair_share", "keyed_share", "crumbs", "top_share", "flat_share", "broken_share", "chars_a_word",
)


def text_stats(text: str | None) -> tuple:
    """Statistics of one text, see SCHEMA."""
    lines = plain_lines(text) if text else []
    n_chars = len(text or "")
    words = text.split() if text else []
    if not lines or not words:
        return (0, n_chars, 0, "und", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, False, 0.0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0)
    plain = "\n".join(lines)
    low = WORD.findall(plain.lower())
    n_low = max(1, len(low))
    common, scores = language_scores(low)
    k = max(range(4), key=scores.__getitem__)
    lang = LANGS[k] if scores[k] >= max(2.0, 0.12 * len(low)) else "und"
    in_sentence = total = cells = entries = ended = logs = keyed = flat = 0
    prose_like = common * 5 >= len(low)
    for l in lines:
        n = l.count(" ") + 1 if prose_like else len(l.split())
        size = len(l)
        total += size
        closed = l.rstrip(_CLOSERS)[-1:] in _STOPS
        ended += closed
        mark = _MARK.match(l)
        if closed and prose_like and not mark and n >= 4 and l[0] not in "|{[<" and "\t" not in l:
            in_sentence += size
            continue
        if _LOG.match(l):
            logs += 1
            continue
        pipes = l.count(" | ")
        if "\t" in l or pipes and (l[0] == "|" or pipes >= 2) or l.startswith(("{|", "|-", "|}", "| ")) or l.endswith("\\\\") and " & " in l:
            cells += 1
            continue
        if not closed:
            if not mark and ";" in l and l.count(";") * 5 >= n and "; " not in l:
                cells += 1
                continue
            if "  " in l and _GAP.search(l):
                cells += 1
                continue
            if n <= 10 and l.count(": ") == 1 and "," not in l and _KEYED.match(l):
                keyed += 1
                entries += 1  # a name and what belongs to it: an entry, though in two parts
                continue
        m = _LAST.match(l)
        head = len(m.group().split()) if m else 0
        if head and (not mark or head >= 5 and not l[mark.end()].islower()):  # an entry that begins in lower case is no sentence, whatever ends it
            part = WORD.findall(m.group().lower())
            if _function_words(part) * 10 >= len(part) and len(part) >= 2:
                in_sentence += m.end()
                if n - head >= 4:
                    rest = WORD.findall(l[m.end():].lower())
                    c = _function_words(rest)
                    if c >= 2 and c * 5 >= len(rest):
                        in_sentence += size - m.end()  # a sentence that was cut off
                    else:
                        entries += 1
                continue
        if not closed and not mark and n >= 4:
            ws = WORD.findall(l.lower())
            c = _function_words(ws)
            if c >= 2 and c * 5 >= n and len({w for w in ws if len(w) < 5}) >= 2 and not l.endswith((",", ";", ":")) and "," not in l[-25:]:
                in_sentence += size
                continue
        if n >= 12 and not closed and not _PARTED.search(l):
            flat += size
        entries += 1
    n_lines = len(lines)
    odd, broken = signs(_URL.sub(" ", plain) if "://" in plain or "@" in plain else plain)
    pair_share = top = 0.0
    by = Counter(low)
    if len(low) >= 8:
        pairs = Counter(zip(low, low[1:]))
        pair_share = sum(n for n in pairs.values() if n > 1) / (len(low) - 1) if len(pairs) < len(low) - 1 else 0.0
        top = max(by.values()) / len(low)
    return (
        len(words), n_chars, n_lines, lang, sum(map(len, low)) / n_low, odd / n_chars, len(_DIGIT.findall(text)) / n_chars, ended / n_lines,
        common / n_low, in_sentence / max(1, total), len(by) / n_low, cells / n_lines, entries / n_lines,
        max(map(len, words)), bool(_JSON.match(text)) or lines[-1][:1] == "{" and bool(_JSON.match(lines[-1])), logs / n_lines, pair_share, keyed / n_lines,
        len(_CRUMB.findall(plain)), top, flat / max(1, total), broken / len(words), n_chars / len(words),
    )


SCHEMA = (
    "words int, chars int, lines int, lang string, mean_word_len double, symbol_ratio double, digit_ratio double, end_line_share double, "
    "common_share double, sentence_share double, distinct_share double, cell_line_share double, entry_line_share double, longest_word int, "
    "is_json boolean, log_share double, pair_share double, keyed_share double, crumbs int, top_share double, flat_share double, broken_share double, chars_a_word double"
)


def paragraph_stats(paragraphs: DataFrame, key: str = "paragraph_id", text: str = "paragraph") -> DataFrame:
    """One row of statistics for each row of the table: ``key`` and SCHEMA."""
    return map_rows(paragraphs, [key], [text], text_stats, SCHEMA)


def sketches(stats: DataFrame) -> DataFrame:
    """KLL sketches by language, plus the row ``*`` merged from them: each statistic over the texts of sentences (``n`` of
    them), and ``every``, the share of sentences over all texts (``total``)."""
    prose = F.col("sentence_share") >= MAINLY
    by = stats.where(F.col("words") > 0).groupBy("lang").agg(
        *[F.kll_sketch_agg_double(F.when(prose, F.col(s).cast("double"))).alias(s) for s in STATS], F.count_if(prose).alias("n"),
        F.kll_sketch_agg_double(F.col("sentence_share")).alias("every"), F.count("*").alias("total"),
    )
    names = [*STATS, "every"]
    whole = by.agg(*[F.kll_merge_agg_double(s).alias(s) for s in names], F.sum("n").alias("n"), F.sum("total").alias("total")).select(F.lit("*").alias("lang"), *names, "n", "total")
    return by.select("lang", *names, "n", "total").unionByName(whole)


def _steps() -> list[float]:
    """Places where the cut may be, those nearest to MAINLY first."""
    k = round(REACH / STEP)
    return sorted((round(MAINLY + i * STEP / 2, 4) for i in range(-2 * k, 2 * k + 1)), key=lambda t: abs(t - MAINLY))


def references(stats: DataFrame, least: int = 200) -> DataFrame:
    """Deciles and median of each statistic by language (``q_...``) and the cut between sentence texts and others (``cut``), both
    from the sketches and drawn towards those of the merged sketch, which counts as ``least`` texts: the weight of a
    language's own figures grows smoothly with its texts. ``und`` is no language and takes the merged."""
    quantiles = lambda c: F.kll_sketch_get_quantile_double(c, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    ranks = F.kll_sketch_get_rank_double("every", F.array(*[F.lit(t + d) for t in _steps() for d in (-STEP, STEP)]))
    within = [F.round(F.col("_r")[2 * i + 1] - F.col("_r")[2 * i], 4) for i in range(len(_steps()))]
    emptiest = F.array_position(F.array(*within), F.array_min(F.array(*within))).cast("int")
    q = sketches(stats).withColumn("_r", F.when(F.col("total") > 0, ranks))
    q = q.select("lang", "n", "total", F.when(F.col("total") > 0, F.element_at(F.array(*map(F.lit, _steps())), emptiest)).alias("cut"), *[F.when(F.col("n") > 0, quantiles(c)).alias(c) for c in STATS])
    one = q.agg(
        F.map_from_entries(F.collect_list(F.struct("lang", F.struct("n", "total", "cut", *STATS)))).alias("own"),  # six entries: the languages and the whole corpus
    ).select(F.explode(F.array(*map(F.lit, (*LANGS, "und")))).alias("lang"), "own")
    own, whole = F.col("own")[F.col("lang")], F.col("own")["*"]
    weight = lambda n: F.when(F.col("lang") == "und", 0.0).otherwise(F.coalesce(own[n] / (own[n] + least), F.lit(0.0)))

    def drawn(c: str) -> Column:
        base = F.coalesce(whole[c], F.array(*map(F.lit, ORDINARY[c])))
        return F.zip_with(F.coalesce(own[c], base), base, lambda o, w: weight("n") * o + (1 - weight("n")) * w)

    base = F.coalesce(whole["cut"], F.lit(MAINLY))
    cut = weight("total") * F.coalesce(own["cut"], base) + (1 - weight("total")) * base
    return one.select("lang", cut.alias("cut"), *[drawn(c).alias(f"q_{c}") for c in STATS])


#: Between the median and a decile of a normal distribution lie so many standard deviations.
DECILE = 1.2816


def z_scores(stats: DataFrame, refs: DataFrame) -> DataFrame:
    """Robust z-scores ``z_...``: distance from the median in units of the spread on that side. Adds ``cut`` too."""
    j = stats.join(F.broadcast(refs), "lang", "left")  # at most one row a language, five in all

    def z(c: str, least: float) -> Column:
        q, d = F.col(f"q_{c}"), F.col(c) - F.col(f"q_{c}")[1]
        return d / F.greatest(F.when(d > 0, q[2] - q[1]).otherwise(q[1] - q[0]) / DECILE, F.lit(least))

    return j.select(*stats.columns, "cut", *[z(c, least).alias(f"z_{c}") for c, least in STATS.items()])


def verdict(z: DataFrame) -> DataFrame:
    """Adds ``flags`` (tails of the distributions) and ``kind``. Unreadable text is junk whatever its sentences; what is not
    mainly sentences is junk by its tails, else a table by its cells, else a list."""
    flags = [F.when(F.col(f"z_{c}") < -TAIL, F.lit(f"low_{c}")).when(F.col(f"z_{c}") > TAIL, F.lit(f"high_{c}")) for c in STATS]
    c = F.col
    high = lambda s, k=1: c(f"z_{s}") > k * TAIL
    celled = high("cell_line_share")
    unreadable = high("broken_share", 2) & (c("words") >= 8) & ~celled
    junk = (
        c("is_json") | high("log_share") | high("crumbs") | high("broken_share", 2)
        | (high("symbol_ratio", 2) | high("longest_word", 2) & high("chars_a_word", 2) | high("pair_share")) & ~celled
        | (c("z_distinct_share") < -TAIL) & high("top_share", 2)
    )
    table = celled | high("flat_share")
    kind = F.when(c("words") == 0, "empty").when(unreadable, "junk").when(c("sentence_share") >= c("cut"), "prose").when(junk, "junk").when(table, "table").otherwise("list")
    return z.select(*z.columns, F.array_compact(F.array(*flags)).alias("flags"), kind.alias("kind"))


def quality(paragraphs: DataFrame, key: str = "paragraph_id", text: str = "paragraph") -> DataFrame:
    """The operator: one row for each row of the table with statistics, z-scores, flags and kind."""
    stats = materialise(paragraph_stats(paragraphs, key, text), "quality")
    return verdict(z_scores(stats, references(stats)))
