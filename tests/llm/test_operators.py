"""The operators of the training-data problems on DataFrames: brute force, edge cases, skew."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import markup, mixing, packing, pairs, quality, readability, sitelines, tokens, truncation

PROSE = "Byen har en havn, og der er mange skibe om sommeren. Folk kommer fra hele landet for at se dem. Det er en gammel tradition, som de fleste kender godt."
TABLE_ROWS = "Navn\tPris\tAntal\nSmør\t12\t4\nBrød\t15\t9\nOst\t40\t2"
LIST_ROWS = "- smør fra gården\n- brød fra byen\n- ost fra landet\n- mælk"
JUNK = "sten mark, sten mark, bil vej, sten mark, bil vej, sten mark, sten mark, bil vej, sten mark, bil vej"


def paragraphs(spark, rows):
    return spark.createDataFrame(rows, "paragraph_id long, paragraph string, source_type string, lang string, words string")


# ------------------------------------------------------------------ 1

def test_quality_verdicts_and_edge_cases(spark):
    rows = [(i, PROSE.replace("Byen", f"By {i}"), "news", "x", "y") for i in range(40)]
    rows += [(100, TABLE_ROWS, None, None, None), (101, LIST_ROWS, "", "", ""), (102, JUNK, "n", "", ""), (103, None, "n", "", ""), (104, "", "n", "", ""), (105, PROSE * 300, "n", "", ""), (106, LIST_ROWS, "n", "", ""), (106, LIST_ROWS, "n", "", "")]
    got = {r.paragraph_id: r.kind for r in quality.quality(paragraphs(spark, rows)).collect()}
    assert {k: got[k] for k in range(100, 107)} == {100: "table", 101: "list", 102: "junk", 103: "empty", 104: "empty", 105: "prose", 106: "list"}
    assert all(got[i] == "prose" for i in range(40))
    assert quality.quality(paragraphs(spark, [])).count() == 0


@pytest.mark.parametrize("prose", [0, 6, 12, 30])
def test_verdict_does_not_depend_on_the_share_of_prose(spark, prose):
    noise = "x#%&= 9!!?? k@@% ~~^^ q+=+= %%§§ z##!! ??%% w&&== ^^~~ 7%%%"
    log = "\n".join(f"2024-01-02 10:00:{i:02d} INFO worker started" for i in range(8))
    other = {"table": TABLE_ROWS, "list": LIST_ROWS, "junk": JUNK, "junk2": '{"navn": "by", "id": 4, "x": [1, 2]}', "junk3": log, "junk4": noise}
    rows = [(i, PROSE.replace("Byen", f"By {i}"), "n", "", "") for i in range(prose)]
    rows += [(100 * k + i, t, "n", "", "") for k, t in enumerate(other.values(), 1) for i in range(4)]
    got = {r.paragraph_id: r.kind for r in quality.quality(paragraphs(spark, rows)).collect()}
    assert {got[i] for i in range(prose)} <= {"prose"}
    for k, kind in enumerate(other, 1):
        assert {got[100 * k + i] for i in range(4)} == {kind.rstrip("234")}, kind


def test_references_have_no_jump_at_a_row_count(spark):
    def median(n):
        rows = [("da", 5, 6.0)] * 2000 + [("de", 5, 9.0)] * n
        df = spark.createDataFrame(rows, "lang string, words int, x double").select("lang", "words", *[F.col("x").alias(s) for s in quality.STATS])
        return {r.lang: r for r in quality.references(df).collect()}["de"].q_mean_word_len[1]

    m = [median(n) for n in (20, 199, 200, 1900)]
    assert 6.0 < m[0] < m[1] < m[2] < m[3] < 9.0 and m[2] - m[1] < 0.02 and m[3] > 8.7


def test_sketches_are_near_exact_quantiles_and_merge(spark):
    r = np.random.default_rng(1)
    v = r.gamma(2.0, 3.0, 20000)
    df = spark.createDataFrame([("da" if i % 3 else "en", 5, float(x)) for i, x in enumerate(v)], "lang string, words int, x double")
    df = df.select("lang", "words", *[F.col("x").alias(s) for s in quality.STATS])
    q = {r.lang: r for r in quality.references(df.repartition(8), least=1).collect()}
    for k, keep in (("da", lambda i: i % 3), ("en", lambda i: not i % 3)):
        exact = np.quantile([x for i, x in enumerate(v) if keep(i) and x >= quality.MAINLY], [0.1, 0.5, 0.9])  # x stands for the share of sentences too
        assert np.allclose(q[k].q_mean_word_len, exact, rtol=0.06)
    whole = {r.lang: r for r in quality.references(df, least=10**9).collect()}
    assert np.allclose(whole["da"].q_mean_word_len, np.quantile(v[v >= quality.MAINLY], [0.1, 0.5, 0.9]), rtol=0.06)


def stats_rows(spark, rows):
    """Statistics of made-up texts: (paragraph_id, lang, {name: value}), the rest as in ordinary prose."""
    base = {n: 0.0 for n in quality.NAMES} | {c: q[1] for c, q in quality.ORDINARY.items()} | {"words": 60, "chars": 400, "lines": 3}
    full = [(i, *[lang if n == "lang" else False if n == "is_json" else (int if n in ("words", "chars", "lines", "longest_word", "crumbs") else float)((base | v)[n]) for n in quality.NAMES]) for i, lang, v in rows]
    return spark.createDataFrame(full, "id long, " + quality.SCHEMA)


def test_the_cut_lies_where_the_shares_are_emptiest(spark):
    r = random.Random(5)
    for low, high in ((0.35, 0.95), (0.05, 0.6)):
        rows = [(i, "da", {"sentence_share": min(1.0, max(0.0, r.gauss(low if i % 2 else high, 0.04)))}) for i in range(3000)]
        stats = stats_rows(spark, rows)
        cut = {x.lang: x.cut for x in quality.references(stats).collect()}["da"]
        assert low + 0.1 < cut < high - 0.1
        kinds = {x.id: x.kind for x in quality.verdict(quality.z_scores(stats, quality.references(stats))).collect()}
        assert all((kinds[i] == "prose") == (i % 2 == 0) for i, *_ in rows)
    assert {x.cut for x in quality.references(stats.limit(0)).collect()} == {quality.MAINLY}


def test_the_sketches_of_a_language_decide_its_tails(spark):
    r = random.Random(6)
    rows = [(i, "da", {"pair_share": r.gauss(0.06, 0.03)}) for i in range(2000)] + [(10_000 + i, "en", {"pair_share": r.gauss(0.5, 0.1)}) for i in range(2000)]
    rows += [(1, lang, {"sentence_share": 0.0, "pair_share": 0.5}) for lang in ("da",)] + [(2, "en", {"sentence_share": 0.0, "pair_share": 0.5})]
    stats = stats_rows(spark, [x for x in rows if x[0] not in (1, 2)] + [(50_001, *rows[-2][1:]), (50_002, *rows[-1][1:])])
    refs = quality.references(stats)
    got = {x.id: x.kind for x in quality.verdict(quality.z_scores(stats, refs)).where("id > 50000").collect()}
    assert got == {50_001: "junk", 50_002: "list"}  # half of all word pairs repeated: usual in one language, not in the other
    flat = refs.withColumns({c: F.lit(None).cast("array<double>") for c in refs.columns if c.startswith("q_")})
    none = {x.id: x.kind for x in quality.verdict(quality.z_scores(stats, flat)).where("id > 50000").collect()}
    assert none != got


# ------------------------------------------------------------------ 2 and 3

def test_markup_and_pairs_with_nulls_and_repeats(spark):
    rows = [(1, "<b>a</b> og [[b]]", "n", "", ""), (1, "<b>a</b> og [[b]]", "n", "", ""), (2, None, "n", "", ""), (3, "", "n", "", ""), (4, PROSE, "n", "", ""), (None, "<b>x</b>", "n", "", "")]
    df = paragraphs(spark, rows)
    assert sorted(map(tuple, markup.markup_found(df).collect())) == [(1, "html"), (1, "wiki")]
    clean = {(r.paragraph_id, r.clean, r.changed) for r in markup.cleaned(df).collect()}
    assert clean == {(1, "a og b", True), (2, None, False), (3, "", False), (4, PROSE, False), (None, "x", True)}
    assert markup.markup_found(df.limit(0)).count() == 0 and markup.cleaned(df.limit(0)).count() == 0
    p = spark.createDataFrame([(1, "Hvad?", None, None, "k"), (1, "Hvad?", None, None, "k"), (2, None, PROSE, None, "k"), (None, "q", "", None, "k")], "pair_id long, instruction string, paragraph string, original_paragraph string, defect string")
    assert list(map(tuple, pairs.defective_pairs(p).collect())) == [(1, "empty")]
    assert pairs.defective_pairs(p.limit(0)).count() == 0


# ------------------------------------------------------------------ 4

def brute_lines(rows, least):
    seen, where = collections.defaultdict(set), collections.defaultdict(set)
    for i, t, s, *_ in rows:
        src = (s or "").strip().lower() or "knowledge"
        for n, l in enumerate((t or "").split("\n"), 1):
            if sum(c.isalpha() for c in l) >= 20 and i is not None:
                k = (src, re.sub("[0-9]+", "0", " ".join(l.split()).lower()))
                seen[k].add(i)
                where[k].add((i, n))
    return {p for k, ids in seen.items() if len(ids) >= least for p in where[k]}


def test_site_lines_are_the_brute_force(spark):
    r = random.Random(4)
    lines = [f"Dette er linje {c} fra redaktionen på avisen" for c in "abcdefghij"] + ["kort linje", "", "Læs mere på siden  om nyheder 12", "LÆS MERE PÅ SIDEN OM NYHEDER 7\r", "Vist 5 gange siden den første januar"]
    rows = [(i, "\n".join(r.choice(lines) if r.random() < 0.4 else f"Egen tekst nummer {r.random()} som kun står her" for _ in range(r.randint(0, 6))), r.choice(["news", " News", None, "speech", ""]), "", "") for i in range(150)]
    rows += rows[:20] + [(900, None, "news", "", ""), (None, lines[0], "news", "", "")]
    places, blocks = sitelines.boilerplate(paragraphs(spark, rows).repartition(5))
    assert {(x.doc, x.line_no) for x in places.collect()} == brute_lines(rows, 10)
    assert {b.docs >= 10 for b in blocks.collect()} == {True}
    cleaned = {x.paragraph_id: x for x in sitelines.clean(paragraphs(spark, rows), places).collect()}
    drop = brute_lines(rows, 10)
    for i, t, *_ in rows[:150]:
        assert cleaned[i].paragraph == "\n".join(l for n, l in enumerate(t.split("\n"), 1) if (i, n) not in drop)
    assert cleaned[900].paragraph is None
    assert sitelines.boilerplate(paragraphs(spark, []))[0].count() == 0


def test_consecutive_lines_are_one_block(spark):
    a, b, c = "Den første faste linje på siden", "Den anden faste linje på siden", "En helt anden fast linje på siden"
    rows = [(i, f"Tekst {i}\n{a}\n{b}", "news", "", "") for i in range(12)] + [(100 + i, f"{c}\nTekst {i}", "news", "", "") for i in range(12)]
    _, blocks = sitelines.boilerplate(paragraphs(spark, rows))
    by = collections.defaultdict(set)
    for x in blocks.collect():
        by[x.block].add(x.line)
    assert sorted(map(sorted, by.values())) == sorted([sorted([a.lower(), b.lower()]), [c.lower()]])


def test_blocks_go_by_their_least_line_and_match_sql(spark, tmp_path):
    import duckdb

    import __spark_entry__ as e

    a, b, c, d = "Den første faste linje på siden", "Den anden faste linje på siden", "En helt anden fast linje på siden", "Ære være den sidste faste linje her"
    rows = [(i, f"Tekst {i}\n{a}\n\n{b}\n{d}", "news") for i in range(12)] + [(100 + i, f"{c}\nTekst {i}\n\n\n{a}", " News") for i in range(12)] + [(200 + i, f"{c}\n{d}", None) for i in range(11)]
    spark.createDataFrame(rows, "paragraph_id long, paragraph string, source_type string").write.parquet(str(tmp_path / "paragraphs.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW paragraphs AS SELECT * FROM '{tmp_path}/paragraphs.parquet/*.parquet'")
    want = con.execute(f"SELECT source, block, line, docs FROM ({e.oracle_sql()['p4_blocks']})").fetchall()
    got = e.queries()["p4_blocks"](spark, str(tmp_path)).select("source", "block", "line", "docs").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert {(s, k, n) for s, k, _, n in want} == {("news", b.lower(), 24), ("news", b.lower(), 12), ("news", c.lower(), 12), ("knowledge", c.lower(), 11)}


def test_components_of_a_long_chain(spark):
    n = 60
    order = list(range(n))
    random.Random(1).shuffle(order)
    nodes = spark.createDataFrame([(i,) for i in range(n + 3)], "node_a long")
    e = [(order[i], order[i + 1], 10) for i in range(n - 1)]
    edges = spark.createDataFrame(e + [(b, a, d) for a, b, d in e], "src long, dst long, docs long")
    got = {r.node_a: r.block for r in sitelines.components(nodes, edges).collect()}
    assert {got[i] for i in range(n)} == {0} and [got[n + i] for i in range(3)] == [n, n + 1, n + 2]


def test_a_line_in_a_third_of_all_documents(spark):
    df = spark.range(30000).select(F.col("id").alias("paragraph_id"), F.concat(F.lit("Egen linje "), F.md5(F.col("id").cast("string")), F.when(F.col("id") % 3 == 0, "\nDenne linje står i en tredjedel af alle").otherwise("")).alias("paragraph"), F.lit("news").alias("source_type"))
    places, _ = sitelines.boilerplate(df)
    assert places.count() == 10000


# ------------------------------------------------------------------ 5

def test_truncation_with_a_field_limit(spark):
    r = random.Random(8)
    whole = []
    for i in range(900):
        t = " ".join("Den " + " ".join("x" * r.randint(2, 9) for _ in range(r.randint(3, 12))) + " havn." for _ in range(r.randint(2, 12)))
        whole.append((i, t))
    rows = [(i, t[:300] if i % 2 else t, t, "news") for i, t in whole] + [(5000, None, None, None), (5001, "", "", "news"), (1, whole[1][1][:300], whole[1][1], "news")]
    df = spark.createDataFrame(rows, "selected_id long, paragraph string, original_paragraph string, source_type string")
    got = {x.selected_id: x.cut for x in truncation.truncated(df).collect()}
    want = {i: bool(i % 2 and len(t) > 300 and t[:300].rstrip()[-1] != ".") for i, t in whole}
    wrong = [i for i in want if got[i] != want[i]]
    assert not wrong and not got[5000] and not got[5001] and len(got) == 902
    lim = truncation.limits(truncation.measures(df, "selected_id", "paragraph", "original_paragraph", F.col("source_type"))).where("unit = 'chars'").collect()
    assert [x.length for x in lim] == [300] and lim[0].posterior > 0.9
    assert truncation.truncated(df.limit(0)).count() == 0


def test_the_posterior_of_a_limit_decides_endings_without_a_stop(spark):
    r = random.Random(4)
    entry = lambda: "- " + " ".join(r.choice(["gamle", "bro", "havn", "skole", "kirke", "torv"]) for _ in range(r.randint(3, 9)))
    rows, cut = [], set()
    for i in range(1500):
        t = "Det drejer sig om:\n" + "\n".join(entry() for _ in range(r.randint(2, 16)))
        if len(t) > 300:
            t = t[:300].rstrip()
            t += "x" * (300 - len(t))
            cut.add(i)
        rows.append((i, t, "news"))
    rows += [(5000 + i, PROSE + " " + "Der er en by. " * i, "news") for i in range(300)]
    df = spark.createDataFrame(rows, "selected_id long, paragraph string, source_type string")
    got = truncation.truncated(df).collect()
    found = {x.selected_id for x in got if x.cut}
    without = {x.selected_id for x in got if x.evidence + np.log(truncation.BASE_RATE / (1 - truncation.BASE_RATE)) > 0}
    at_limit = {i for i, t, _ in rows if i < 5000 and len(t) == 300}
    assert cut <= at_limit and found == at_limit and len(found - without) > 0.05 * len(rows)
    whole = truncation.truncated(df.withColumn("whole", F.col("paragraph")), original="whole").where("selected_id >= 5000 and cut").count()
    assert whole == 0


# ------------------------------------------------------------------ 6

def test_budget_counts_each_passage_once(spark):
    rows = [(1, "En by.", "News", "da-DK", "https://www.a.dk/x"), (1, "En by.", "News", "da-DK", "https://www.a.dk/x"), (2, "En by.", " news", "DA", "http://www.a.dk:80/y"), (3, "To byer.", None, None, "None"), (4, None, "news", "da", None), (None, "x", "news", "da", None)]
    df = spark.createDataFrame(rows, "selected_id long, paragraph string, source_type string, lang string, url string")
    n = {t: tokens.count_tokens(t) for t in ("En by.", "To byer.")}
    got = {(r.level, r.source, r.lang, r.domain): (r.passages, r.distinct_texts, r.tokens, r.distinct_tokens) for r in tokens.budget(df).collect()}
    assert got["slice", "news", "da", "www.a.dk"] == (2, 1, 2 * n["En by."], n["En by."])
    assert got["slice", "knowledge", "und", "unknown"] == (1, 1, n["To byer."], n["To byer."])
    assert got["all", "*", "*", "*"] == (4, 3, 2 * n["En by."] + n["To byer."], n["En by."] + n["To byer."])
    assert got["source", "news", "*", "*"][0] == 3 and got["lang", "*", "da", "*"][0] == 3 and got["domain", "*", "*", "unknown"][0] == 2
    each = {r.selected_id: (r.tokens, r.copies) for r in tokens.counted(df, "selected_id", "paragraph", tokens.slices(), tokens.VOCABULARY).collect()}
    assert each == {1: (n["En by."], 3), 2: (n["En by."], 3), 3: (n["To byer."], 1), 4: (0, 0)}
    totals = {r.selected_id: (r.slice_passages, r.slice_tokens) for r in tokens.with_slice_totals(tokens.counted(df, "selected_id", "paragraph", tokens.slices(), tokens.VOCABULARY), "selected_id").collect()}
    assert totals == {1: (2, 2 * n["En by."]), 2: (2, 2 * n["En by."]), 3: (1, n["To byer."]), 4: (1, 0)}
    assert tokens.budget(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 7

def test_containers_hold_everything_once(spark):
    r = random.Random(2)
    rows = [(i, "by " * r.choice((0, 1, 5, 40, 90, 300, 1500))) for i in range(500)] + [(9000, None), (9001, ""), (3, "by"), (None, "by by")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    size = {}
    for i, t in rows:
        if i is not None:
            size[i] = max(size.get(i, 0), tokens.count_tokens(t))
    out = packing.containers(df, [("s", [128]), ("l", [1024]), ("joint", [128, 1024])], shard_items=200).collect()
    for name, cap in (("s", 128), ("l", 1024), ("joint", 1024)):
        pieces, bins = collections.defaultdict(list), collections.defaultdict(list)
        for x in (y for y in out if y.profile == name):
            pieces[x.doc_id].append((x.piece, x.first_token, x.tokens))
            bins[x.container, x.capacity].append(x)
        assert set(pieces) == set(size)
        for i, p in pieces.items():
            assert sum(t for *_, t in p) == size[i] and len(p) == max(1, -(-size[i] // cap))
            assert all(a == sum(t for *_, t in sorted(p)[:k]) for k, (_, a, _) in enumerate(sorted(p)))
        assert len({c for c, _ in bins}) == len(bins)
        assert all(sum(y.tokens for y in b) == b[0].filled <= c <= cap for (_, c), b in bins.items())
        assert sum(size.values()) > 0.93 * sum(c for _, c in bins)
    assert packing.containers(df.limit(0), [("s", [128])]).count() == 0
    with pytest.raises(ValueError):
        packing.read_profiles(spark.range(3).select(F.col("id").cast("string").alias("profile"), F.lit(5).alias("capacity")), limit=2)


def test_profiles_beyond_one_pass_are_filled_too(spark, monkeypatch):
    df = spark.createDataFrame([(i, "by " * (i % 50)) for i in range(60)], "doc_id long, text string")
    plan = [(f"p{k}", [64 + k]) for k in range(5)]
    once = sorted(map(tuple, packing.containers(df, plan).collect()))
    monkeypatch.setattr(packing, "PROFILES", 2)
    assert sorted(map(tuple, packing.containers(df, plan).collect())) == once and len({x[0] for x in once}) == 5
    assert packing.containers(df, []).count() == 0


def test_joint_packing_chooses_several_lengths_and_keeps_keys_of_any_type(spark):
    r = random.Random(7)
    rows = [(f"d{i}", "by " * int(min(4000, r.paretovariate(0.9) * 40)), "x") for i in range(700)] + [("d1", "by", "x")]
    df = spark.createDataFrame(rows, "doc_id string, text string, shard string")
    out = packing.containers(df, [("joint", [512, 2048, 8192])], shard_items=100, attention=packing.ATTENTION)
    assert out.rdd.getNumPartitions() == 7 and dict(out.dtypes)["doc_id"] == "string"
    got = out.collect()
    assert {x.doc_id for x in got} == {k for k, *_ in rows}
    bins = {(x.container, x.capacity): x.filled for x in got}
    assert {c for _, c in bins} >= {512, 2048} and all(f <= c for (_, c), f in bins.items())
    assert all(f > max([0, *(c for c in (512, 2048) if c < cap)]) for (_, cap), f in bins.items())  # downsized to the contents
    one = {(x.container, x.capacity): x.filled for x in packing.containers(df, [("one", [8192])], shard_items=100).collect()}
    cost = lambda b: sum(packing.bin_cost(c, packing.ATTENTION) for _, c in b)
    assert cost(bins) < 0.7 * cost(one)


# ------------------------------------------------------------------ 8

def test_mix_meets_its_budgets(spark):
    r = random.Random(3)
    rows = [(i, "by og land " * r.randint(0, 30), r.choice(["a", " A", "a", "b", "c"])) for i in range(3000)] + [(9000, None, "a"), (9001, "by", None), (None, "by", "a"), (5, "by", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("m", "a", 0.5, 1), ("m", "b", 0.3, 2), ("m", "c", 0.1, 3), ("m", "none", 0.1, 4), ("n", "a", 0.2, 1), ("n", "b", 0.8, 2), (None, "a", 1.0, 1)], "mix string, source string, target_share double, max_repeats int")
    uses, shares = mixing.mixed(df, t)
    u = uses.collect()
    supply, size = collections.Counter(), {}
    one = {}
    for i, x, s in rows:
        if i is not None:
            one[i] = max(one.get(i, ("", -1)), ((s or "unknown").strip().lower(), tokens.count_tokens(x)))
    for i, (s, k) in one.items():
        supply[s] += k
        size[i] = k
    largest = max(size.values())
    for mix, share, cap in (("m", {"a": 0.5, "b": 0.3, "c": 0.1}, {"a": 1, "b": 2, "c": 3}), ("n", {"a": 0.2, "b": 0.8}, {"a": 1, "b": 2})):
        total = sum(supply[s] for s in share)
        for s in share:
            got = [x for x in u if x.mix == mix and x.source == s]
            wanted = min(share[s] * total, cap[s] * supply[s])
            assert wanted - largest <= sum(x.tokens * x.repeats for x in got) <= wanted + 1e-6, (mix, s)
            assert max(x.repeats for x in got) <= cap[s] and max(x.repeats for x in got) - min(x.repeats for x in got) <= 1
    small, large = ({x.doc_id for x in u if x.mix == m and x.source == "a"} for m in ("n", "m"))
    assert small < large  # nested thresholds
    rep = {(x.mix, x.source): x for x in shares.collect()}
    assert rep["m", "none"].tokens == 0 and abs(sum(x.share_reached for (m, _), x in rep.items() if m == "m") - 1) < 1e-9
    assert mixing.mixed(df.limit(0), t)[0].count() == 0 and mixing.mixed(df, t.limit(0))[0].count() == 0


def test_many_targets_take_the_salted_join_and_choose_the_same(spark, monkeypatch):
    r = random.Random(3)
    df = spark.createDataFrame([(i, "by og land " * r.randint(0, 30), r.choice("aaab"), 1, "y") for i in range(800)], "doc_id long, text string, source string, salt int, mix string")
    t = spark.createDataFrame([(f"m{k}", s, w, 2) for k in range(6) for s, w in (("a", 0.1 * k), ("b", 1 - 0.1 * k))], "mix string, source string, target_share double, max_repeats int")
    few = sorted(map(tuple, mixing.mixed(df, t)[0].collect()))
    monkeypatch.setattr(mixing, "FEW_TARGETS", 0)
    assert sorted(map(tuple, mixing.mixed(df, t)[0].collect())) == few and few


def test_mix_of_equal_hash_ranges_is_exact_at_the_ends(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("by").alias("text"), F.lit("a").alias("source"))
    t = lambda share, rep: spark.createDataFrame([("m", "a", share, rep)], "mix string, source string, target_share double, max_repeats int")
    for share, rep, want in ((1.0, 1, 200), (0.5, 1, 100), (2.0, 2, 400), (0.0, 1, 0), (3.0, 2, 400), (0.005, 1, 1)):
        u = mixing.mixed(df, t(share, rep))[0]
        assert (u.agg(F.sum(F.col("repeats"))).first()[0] or 0) == want, share


# ------------------------------------------------------------------ 9

EASY = "Mor har en kat. Katten er sort. Den kan løbe. Hvor er den nu? Der er den! Vi ser den. Den er glad. Far går hjem nu. Han har en is."
HARD = ("Uanset at de administrative forvaltningsprincipper, der ifølge retspraksis forudsætter en institutionel proportionalitetsvurdering, almindeligvis nødvendiggør omfattende dokumentationsforpligtelser, "
        "må det konkluderes, at de samfundsmæssige reguleringsstrategier, som litteraturen gentagne gange understreger, tilsidesætter de grundlæggende legitimitetsbetragtninger. ") * 2


def test_reading_levels(spark):
    docs = [(i, PROSE.replace("Byen", f"By{i}")) for i in range(30)] + [(100 + i, EASY) for i in range(15)] + [(200 + i, HARD) for i in range(15)]
    docs += [(900, None), (901, ""), (902, "kort"), (903, LIST_ROWS * 4), (904, JUNK), (905, TABLE_ROWS), (1, docs[1][1])]
    grades = [(i, "r", 5, 1) for i in range(30)] + [(100 + i, "r", 2, 1) for i in range(15)] + [(200 + i, "r", 9, 1) for i in range(15)] + [(0, "s", None, 1), (0, "r", 5, 1)]
    g = spark.createDataFrame(grades, "doc_id long, rater string, grade int, rated_at int")
    got = {r.doc_id: r.level for r in readability.reading_levels(spark.createDataFrame(docs, "doc_id long, text string"), g).collect()}
    assert {got[i] for i in range(30)} == {"ordinary"} and {got[100 + i] for i in range(15)} == {"easy"} and {got[200 + i] for i in range(15)} == {"hard"}
    assert {got[i] for i in range(900, 906)} == {"none"} and len(got) == 66
    none = spark.createDataFrame([], "doc_id long, text string")
    assert readability.reading_levels(none, g.limit(0)).count() == 0


@pytest.mark.parametrize("top", [3, 50_000])
def test_coverage_ranks_are_exact_beyond_the_broadcast(spark, top):
    r = random.Random(6)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    docs = [(i, " ".join(vocabulary[int(r.paretovariate(0.7)) % 300] for _ in range(r.randint(0, 60)))) for i in range(120)]
    n = collections.Counter(w for _, t in docs for w in t.split())
    rank = {w: sum(m >= k for m in n.values()) for w, k in n.items()}
    got = {x.doc_id: x for x in readability.profiles(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shares=(0.5, 0.9), top=top).collect()}
    for i, t in docs:
        ranks = sorted(rank[w] for w in t.split())
        assert got[i].cover90 == (ranks[-(-len(ranks) * 9 // 10) - 1] if ranks else None)
        assert got[i].cover50 == (ranks[-(-len(ranks) // 2) - 1] if ranks else None)


def test_ranks_are_counted_by_language(spark):
    da, en = "Det er en by, og den er ikke stor. ", "The town is not large, and it was there. "
    docs = [(1, da * 3 + "havn"), (2, da + "havn kirke"), (3, en * 40 + "harbour")]
    ranks = readability.word_ranks(readability.word_counts(spark.createDataFrame(docs, "doc_id long, text string"), "text")).collect()
    n = {l: collections.Counter() for l in ("da", "en")}
    for i, t in docs:
        n["en" if i == 3 else "da"].update(readability.word_list(t))
    assert {(r.lang, r.word): r.rank for r in ranks} == {(l, w): sum(m >= k for m in c.values()) for l, c in n.items() for w, k in c.items()}


def test_the_coverage_rank_decides_levels(spark, monkeypatch):
    r = random.Random(9)
    few, many = ["bager", "havet", "sofie", "katte"], ["".join(r.choice("bdfgklmn") + r.choice("aeiou") for _ in range(2)) + "t" for _ in range(4000)]
    text = lambda words: " ".join(f"Og {r.choice(words)} {r.choice(words)} {r.choice(words)} det {r.choice(words)} {r.choice(words)} {r.choice(words)}." for _ in range(12))
    docs = [(i, text(few if i % 2 else many)) for i in range(60)]
    g = spark.createDataFrame([(i, "r", 2 if i % 2 else 9, 1) for i in range(40)], "doc_id long, rater string, grade int, rated_at int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    level = lambda: {x.doc_id: x.level for x in readability.reading_levels(df, g).collect()}
    assert all(v == ("easy" if i % 2 else "hard") for i, v in level().items())
    monkeypatch.setattr(readability, "TERMS", {k: e for k, e in readability.TERMS.items() if k not in ("core", "rank")})
    assert sum(v == ("easy" if i % 2 else "hard") for i, v in level().items()) < 20


# ------------------------------------------------------------------ all

def test_every_query_runs(spark, data):
    import __spark_entry__ as e

    names = [n for n in e.queries() if re.match(r"p\d_", n)]
    assert {n.split("_")[0] for n in names} == {f"p{i}" for i in range(1, 10)}
    columns = {"p1_found": ["paragraph_id", "kind"], "p2_found": ["paragraph_id", "markup"], "p3_found": ["pair_id", "defect"], "p4_found": ["paragraph_id", "line_no"], "p5_found": ["selected_id"], "p9_found": ["doc_id", "level"]}
    for n in names:
        df = e.queries()[n](spark, data)
        rows = df.collect()
        assert rows, n
        if n in columns:
            assert df.columns == columns[n] and len(set(rows)) == len(rows)
