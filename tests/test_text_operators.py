"""Splits, cleaning and rules against plain Python over random texts made of hostile pieces, and at the borders of each rule."""

import random

import plain
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import fixed
from corpusforge.operators import clean, rules, split

PIECES = (
    "\n", "\n", "\n\n", " ", " ", "  ", " ", " ", "\x1c", "\r\n", "\t", "# ", "## Navn", "\n### Historie ", "\n## ", "#### x", "TALER 186: ", "Kilde: http://e/1", "\nKilde:", "\nPubliceret: 2024-01-02", "\nKategorier: x",
    "* ", "- ", "| ", "1.", "2.", "\n* punkt", "ord", "Hus.", "By!", "Hvorfor? ", "aa", "paa", "Aarhus", "skulde", "thi", "1999", "(2020)", "2021,", "papa", "tilskukud", "parallelle", "kr", "xz", "åå", "é", "\"citat her\"",
    "»hej du«", "“nej du”", "„ja du“", "– ", "\n» ", "[a](b)", "[lang tekst](http://e/x)", "stub", "denne artikel", "д", "語", "\U00020001", "²", "½", "٣", "en lang linje med mange ord der ender her.", " og", " det er",
)


def texts(n=400, seed=1):
    r = random.Random(seed)
    fixed_ones = ["", " ", "\n\n", "a" * 99, "a" * 100, "b. " * 1000, "c" * 3001, "ord " * 900, ("linje et to tre\n" * 300), "x. y. z."]
    return fixed_ones + ["".join(r.choice(PIECES) + r.choice(("", " ", " ", "\n")) for _ in range(r.choice((3, 12, 40, 160)))) for _ in range(n)]


@pytest.fixture(scope="module")
def sample(spark):
    t = texts()
    return t, spark.createDataFrame(list(enumerate(t)), "i int, paragraph string").repartition(4).cache()


def test_sections(sample):
    t, df = sample
    got = {r.i: [(s.heading, s.body) for s in r.s] for r in df.select("i", split.sections(F.col("paragraph")).alias("s")).collect()}
    for i, x in enumerate(t):
        assert got[i] == plain.sections(x), repr(x)


@pytest.mark.parametrize("limit", [60, 3000])
def test_chunks(sample, limit):
    t, df = sample
    got = {r.i: r.s for r in split.with_chunks(df, "paragraph", limit, "s").select("i", "s").collect()}
    for i, x in enumerate(t):
        assert got[i] == plain.chunks(x, limit), repr(x)


def test_clean_and_url(sample):
    t, df = sample
    for r in df.select("i", clean.cleaned(F.col("paragraph")).alias("c"), clean.metadata_url(F.col("paragraph")).alias("u")).collect():
        assert (r.c, r.u) == (plain.cleaned(t[r.i]), plain.kilde(t[r.i])), repr(t[r.i])


def test_rules(sample):
    t, df = sample
    names = ["length", "list", "links", "stub", "years", "sentences", "foreign_script", "doubled", "stray", "quotes", "boilerplate", "old_spelling"]
    made = {"length": rules.length(), "list": rules.mostly_list(), "links": rules.links(), "stub": rules.stub(), "years": rules.years(), "sentences": rules.few_sentences(), "foreign_script": rules.foreign_script(),
            "doubled": rules.doubled(), "stray": rules.stray(), "quotes": rules.quotes(), "boilerplate": rules.boilerplate(), "old_spelling": rules.old_spelling()}
    seen = dict.fromkeys(names, 0)
    for r in rules.with_parts(df).select("i", *[made[n].alias(n) for n in names]).collect():
        want = plain.rules(t[r.i])
        for n in names:
            assert r[n] == want[n], (n, t[r.i])
            seen[n] += r[n]
    assert all(0 < k < len(t) for k in seen.values()), seen


def judge(spark, rule, *cases):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, paragraph string")
    return [r.v for r in rules.with_parts(df).select("i", rule.alias("v")).orderBy("i").collect()]


def test_borders(spark):
    assert judge(spark, rules.length(), "x" * 99, "x" * 100, "x" * 3000, "x" * 3001, None) == [True, False, False, True, True]
    assert judge(spark, rules.mostly_list(), "* a\nb", "* a\n- b\nc", "4. a\n10. b", "1.5 mio", "") == [False, True, False, True, True]
    assert judge(spark, rules.doubled(), "i 2020 og 1919", "i 2020", "parallelle parallelle", "føføre tilskukud") == [True, False, False, True]
    assert judge(spark, rules.stray(), "kr " * 1 + "ord " * 19, "kr kr " + "ord " * 18) == [False, True]
    assert judge(spark, rules.old_spelling(), "paa " + "ord " * 18, "paa " + "ord " * 19, "Aarhus " + "ord " * 19, "thi " + "ord " * 99, "thi " + "ord " * 98) == [False, True, False, False, True]
    assert judge(spark, rules.boilerplate(), "a\nb\nc d e f g h i j k\nl m n o p q r s t u", "a\nb", "a\nb\nc") == [False, False, True]


def test_headings(spark):
    cases = ["Se også", "ÆRESBEVISNINGER", "valgresultater", "episode", "", None, "Historie"]
    df = spark.createDataFrame([(i, x, "") for i, x in enumerate(cases)], "i int, section_heading string, paragraph string")
    got = [r.v for r in rules.with_parts(df).select("i", rules.heading().alias("v")).orderBy("i").collect()]
    assert got == [True, True, True, False, False, False, False]
    assert len(fixed.SKIPPED_HEADINGS) == 47


def test_null_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b")], "doc_id int, text string, verdict string")
    assert split.explode_parts(df, "text", False).count() == 0
    assert rules.judged(df.withColumnRenamed("text", "paragraph"), False).select("verdict").distinct().collect()[0][0] == "length"
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert split.explode_parts(empty, "text", True).count() == 0


def test_wiki_choice():
    assert split.is_wiki_like("x_Wikipedia", "") and split.is_wiki_like("y", "WIKIPEDIA") and not split.is_wiki_like("wikipedia", "ft") and not split.is_wiki_like("news", "")
