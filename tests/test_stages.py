"""Deduplication against the greedy loop, ordering, resuming, completion and cache, instruction checks, the pipeline end to end."""

import hashlib
import json
import os
import random

import pytest
from difflib import SequenceMatcher
from pyspark.sql import functions as F

from corpusforge.functions import fixed
from corpusforge.operators import completion, dedup, instruct, ordering, resume, verbatim
from corpusforge.plans import cli, pipeline, stages
from corpusforge.sources import cache, settings, tables

PROSE = "Byen har en havn, og der er mange skibe om sommeren. Folk kommer fra hele landet for at se dem. Det er en gammel tradition, som de fleste kender godt. "


# ------------------------------------------------------------------ deduplication

def greedy(texts, threshold=0.7):
    """A pass in order over an index of buckets: each row still there removes all others that share a bucket, but the first."""
    b, r = dedup.lsh_bands(threshold, 128)
    sig = [tuple(map(tuple, dedup.signature(t, b * r).reshape(b, r))) for t in texts]
    gone = set()
    for i in range(len(texts)):
        if i in gone:
            continue
        hits = sorted(j for j in range(len(texts)) if any(x == y for x, y in zip(sig[i], sig[j])))
        gone |= set(hits[1:])
    return [i for i in range(len(texts)) if i not in gone]


def test_bands():
    assert dedup.lsh_bands(0.7, 128) == (14, 9)


def test_dedup_is_the_greedy_pass(spark):
    r = random.Random(3)
    vocabulary = [f"ord{i}" for i in range(400)]
    texts = []
    for _ in range(60):
        base = [r.choice(vocabulary) for _ in range(30)]
        for _ in range(r.choice((1, 1, 2, 4))):
            texts.append(" ".join(w if r.random() > 0.06 else r.choice(vocabulary) for w in base))
    r.shuffle(texts)
    texts += [texts[0], "", "", "én", "Én!"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    kept = sorted(x.i for x in dedup.first_of_their_kind(df, ["i"], "t").collect())
    assert kept == greedy(texts)
    assert len(kept) < len(texts) - 20


def test_dedup_nulls_ties_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, "a b", "z"), (3, "a b", "z")], "seq int, t string, bands string")
    assert sorted(x.seq for x in dedup.deduplicated(df, ["seq"], "t").collect()) == [1, 3, 3]
    assert dedup.deduplicated(df.limit(0), ["seq"], "t").count() == 0


def test_dedup_of_one_hot_text(spark):
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "altid den samme tekst her").otherwise(F.concat(F.lit("tekst "), F.md5(F.col("id").cast("string")))).alias("t"))
    kept = dedup.first_of_their_kind(df, ["id"], "t")
    assert kept.where("id % 3 = 0").collect()[0].id == 0 and kept.where("id % 3 = 0").count() == 1


def test_dedup_tells_rows_of_one_place_apart_and_joins_nulls(spark):
    rows = [(None, 1, "en by ved havet", "x"), (None, 1, "en by ved havet", "x"), (None, None, "helt andre ord om skove", "x"), (2, 1, "en by ved havet", "y"), (3, 1, "tredje slags tekst her nu", None), (3, 1, "fjerde sag uden lighed overhovedet", None)]
    df = spark.createDataFrame(rows, "doc_seq int, chunk_idx int, t string, _row string")
    kept, passes = dedup.without_near_duplicates(df, ["doc_seq", "chunk_idx"], ["t"])
    assert sorted((r.t, r._row) for r in kept.na.fill("-").collect()) == [("en by ved havet", "x"), ("fjerde sag uden lighed overhovedet", "-"), ("helt andre ord om skove", "x"), ("tredje slags tekst her nu", "-")]
    assert passes[0].count() == 4
    df2 = spark.createDataFrame([(None, "a b c"), (1, "d e f")], "seq int, t string")
    assert dedup.deduplicated(df2, ["seq"], "t").count() == 2
    none, _ = dedup.without_near_duplicates(df.limit(0), ["doc_seq"], ["t"])
    assert none.count() == 0


def test_postprocess_leaves_one_of_identical_rows_and_the_first_of_near_ones(spark, tmp_path, capsys):
    near = PROSE.replace("Byen", "Byeb")
    rows = [(PROSE, "Hvad er der i den by, som er nævnt?", "2", 0), (PROSE, "Hvad er der i den by, som er nævnt?", "2", 0), (near, "Hvorfor er det helt andet end det, vi talte om i går?", "1", 0), ("Noget helt andet om skove og dyr. Rådyr lever der.", "Hvem bor i skoven, når vinteren kommer?", None, None), ("t", "Jeg beklager", None, None)]
    df = spark.createDataFrame(rows, "paragraph string, instruction string, doc_seq string, chunk_idx int")
    tables.write_jsonl(df.repartition(3), str(tmp_path / "with_instructions.jsonl"))
    pipeline.run_postprocess(spark, settings.load_settings(str(tmp_path), 1.0, {}))
    final = spark.read.parquet(str(tmp_path / "final.parquet")).collect()
    assert sorted(r.messages[1].content for r in final) == sorted([near, rows[3][0]])  # place 1 goes before place 2
    assert sorted(r.prompt_id for r in final) == ["prompt_0", "prompt_1"]
    assert "5 pairs" in (out := capsys.readouterr().out) and "4 kept, 1 removed (20.0 %)" in out and "3 kept" not in out.split("answers")[1]


def test_dedup_by_pieces_of_a_vocabulary(spark):
    voc = settings.VOCABULARY
    if not os.path.exists(voc):
        pytest.skip("no vocabulary")
    texts = ["Byen har en havn ved vandet", "byen har en havn ved vandet", "Byen har en havn ved vandet", "", None, "🙂 ok", "x" * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    b, r = dedup.lsh_bands(0.7, 128)
    sig = [tuple(map(tuple, dedup.signature(t, b * r, voc).reshape(b, r))) for t in texts]
    want = [i for i in range(len(texts)) if not any(any(x == y for x, y in zip(sig[i], sig[j])) for j in range(i))]
    assert sorted(x.i for x in dedup.first_of_their_kind(df, ["i"], "t", vocabulary=voc).collect()) == want
    assert dedup.tokens("Byen byen", voc) != dedup.tokens("byen byen", voc) and dedup.tokens("a b a") == {"a", "b"}


# ------------------------------------------------------------------ order

def test_numbers_are_dense_and_random(spark):
    rows = ordering.numbered(spark.range(5000), 42, "id").collect()
    assert sorted(r.row_no for r in rows) == list(range(5000))
    want = sorted(range(5000), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    assert [r.id for r in sorted(rows, key=lambda r: r.row_no)] == want


def test_numbers_over_many_ranges_and_without_a_place(spark):
    assert [ordering.range_digits(n) for n in (0, 4_096_000_000, 4_096_000_001, 10**11, 10**15)] == [3, 3, 4, 5, 6]
    d = spark.range(300).select("id", F.lit(None).cast("string").alias("place"))
    rows = ordering.numbered(d, 42, "place", F.when(F.col("place").isNull(), F.col("id")), range_rows=0).collect()
    assert sorted(r.row_no for r in rows) == list(range(300)) and [r.id for r in sorted(rows, key=lambda r: r.row_no)] != list(range(300))
    assert ordering.numbered(d.limit(0), 42, "id").count() == 0


def test_sample(spark):
    assert ordering.sampled(spark.range(100), 0, 1, "id").count() == 100
    a, b = ({r.id for r in ordering.sampled(spark.range(100), 10, s, "id").collect()} for s in (1, 2))
    assert len(a) == len(b) == 10 and a != b


# ------------------------------------------------------------------ resume, cache, completion

def test_remaining_keeps_nulls_and_duplicates(spark):
    docs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "paragraph string, _h1 int").withColumnRenamed("_h1", "n")
    done = spark.createDataFrame([("b",), (None,)], "original_paragraph string")
    assert sorted(r.n for r in resume.remaining(docs, done, "paragraph", "original_paragraph").collect()) == [1, 2, 4]


def test_completion_calls_once_and_never_again(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.write_text("")
    path = str(calls)

    def counting(system, prompt):
        with open(path, "a") as f:
            f.write("x\n")
        return None if "intet" in prompt else prompt.upper()

    df = spark.createDataFrame([("en",), ("to",), ("en",), ("intet",)], "prompt string")
    for _ in range(2):
        out = completion.completed(df, counting, "s", "m", 0.3, str(tmp_path / "cache"))
        assert sorted((r.prompt, r.response) for r in out.collect()) == [("en", "EN"), ("en", "EN"), ("intet", None), ("to", "TO")]
        out.count()
    assert len(calls.read_text().split()) == 4  # en, to, intet; then intet again, as nothing came of it


def test_requests_in_flight_are_bounded():
    for most in (1, 7, 50, 1000):
        for cores in (1, 8, 64, 4000):
            tasks, each = completion.request_tasks(most, cores)
            assert 1 <= tasks * each <= most


def test_retries_give_up():
    waits = []

    def fails(system, prompt):
        raise OSError

    assert completion.with_retries(fails, "", "", 5, waits.append) is None
    assert len(waits) == 5 and all(1 <= w <= 30 for w in waits)


def test_cache_key_depends_on_everything(spark):
    df = spark.createDataFrame([("a",)], "p string")
    keys = {df.select(cache.cache_key(m, t, s, F.col("p"))).first()[0] for m in "ab" for t in (0.1, 1.0) for s in "xy"}
    assert len(keys) == 8


# ------------------------------------------------------------------ checks

def test_format_choice(spark):
    texts = ["a", "Æble", "", "x" * 5000, "日本"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(instruct.format_choice(F.col("t"))).collect()]
    assert got == ["ABC"[int(hashlib.sha256(t.encode()).hexdigest(), 16) % 3] for t in texts]


def test_labels_language_refusals_and_verdicts(spark):
    one = lambda rows, schema, c: [r[0] for r in spark.createDataFrame(rows, schema).select(c).collect()]
    labelled = [("Format B: hej",), ("  Format C\n\nhej ",), ("Format A — hej",), ("Format D: hej",), ("format a: hej",)]
    assert one(labelled, "i string", instruct.without_label(F.col("i"))) == ["hej", "hej", "hej", "Format D: hej", "format a: hej"]
    words = [("x " * 7,), ("og " + "x " * 15,), ("og " + "x " * 16,), ("Og, " + "x " * 9,)]
    assert one(words, "i string", instruct.looks_danish(F.col("i"))) == [True, True, False, False]
    pairs = [("Jeg beklager, nej", "t"), ("I’m sorry", "t"), ("I'm sorry", "t"), ("hej", None), (None, "t"), ("", "t"), ("hej", "t")]
    assert one(pairs, "i string, a string", instruct.usable(F.col("i"), F.col("a"))) == [False, True, False, False, False, False, True]
    responses = [(None, True), ("", True), (" skip ", True), ("k", False), ("x" * 150, False), ("x" * 150, True)]
    assert one(responses, "r string, v boolean", instruct.select_verdict(F.col("r"), F.col("v"))) == ["fail", "fail", "skip", "short", "verify", "kept"]
    assert one([("ft",), ("ukendt",), (None,)], "s string", instruct.source_type(F.col("s"))) == ["speech", "knowledge", "knowledge"]


def test_verbatim_is_difflib(spark):
    source = PROSE * 4
    cases = [(source, source[40:340]), (source, source[40:340].replace("om", "on", 1)), (source, " ".join(w for i, w in enumerate(source[:500].split()) if i % 9)), (source, "  " + source[5:90].replace(" ", "\n")), (source, ""), (None, None), (None, "a"), (source, "noget helt andet")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s string, e string")
    got = [r.verbatim for r in verbatim.verbatim(df, "s", "e").orderBy("i").collect()]
    squeeze = lambda t: " ".join((t or "").split())
    want = []
    for s, e in cases:
        s, e = squeeze(s), squeeze(e)
        want.append(e in s or sum(b.size for b in SequenceMatcher(None, s, e).get_matching_blocks()) / len(e) >= 0.9)
    assert got == want and True in want and False in want


# ------------------------------------------------------------------ sources, command line

def test_shared_tables_are_deleted_and_need_a_shared_folder(spark, tmp_path):
    from corpusforge.sources import shared

    with shared.scope():
        d = shared.materialise(spark.range(3), "x")
        path = d._corpusforge_path
        assert d.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)
    d = shared.materialise(spark.range(3), "x")
    shared.discard(d)
    assert not os.path.exists(d._corpusforge_path)

    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            master = "yarn"
            getConf = staticmethod(lambda: Session.conf)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session)


def test_a_broken_off_replacement_is_recovered(spark, tmp_path):
    out = str(tmp_path / "s.jsonl")
    df = spark.createDataFrame([("a",)], "paragraph string")
    tables.replace_jsonl(df, out)
    tables.replace_jsonl(spark.read.json(out).unionAll(df), out)
    assert spark.read.json(out).count() == 2 and not os.path.exists(out + ".old") and not os.path.exists(out + ".new")
    os.rename(out, out + ".old")
    tables.write_jsonl(df, out + ".new")
    tables.recover(spark, out)
    assert spark.read.json(out).count() == 1  # the new one was whole
    os.rename(out, str(tmp_path / "gone"))
    tables.recover(spark, out)
    assert spark.read.json(out).count() == 2  # else the old one


def test_remote_dataset(spark, tmp_path):
    import functools
    import http.server
    import threading

    spark.createDataFrame([(1, "æble", None), (2, None, "u")], "id int, text string, link string").coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(3, "pære")], "id int, text string").coalesce(1).write.parquet(str(tmp_path / "b"))
    part = {n: next((tmp_path / n).glob("*.parquet")).name for n in "ab"}
    (tmp_path / "index.json").write_text(json.dumps([f"a/{part['a']}", f"b/{part['b']}"]))
    handler = functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path))
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        url = f"http://127.0.0.1:{server.server_port}"
        got = tables.read_source(spark, url, "text", "id", "link").orderBy("doc_seq").collect()
        assert [(r.text, r.title, r.url) for r in got] == [("æble", "1", None), ("pære", "3", None)]
        assert tables.read_source(spark, f"{url}/b/{part['b']}", "text", "", "").count() == 1
        with pytest.raises(Exception, match="no column"):
            tables.read_source(spark, url, "link", "", "").count()
        server.shutdown()


def test_source_keeps_its_order(spark, tmp_path):
    spark.createDataFrame([(i, f"t{i}") for i in range(30)], "id int, text string").coalesce(1).write.parquet(str(tmp_path / "s"))
    rows = tables.read_source(spark, str(tmp_path / "s"), "text", "id", "").repartition(4).orderBy("doc_seq").collect()
    assert [r.text for r in rows] == [f"t{i}" for i in range(30)]


def test_settings_and_defaults(tmp_path):
    s = settings.load_settings(str(tmp_path / "d"), 0.3, {"OPENAI_API_KEY": "k", "MAX_CONCURRENCY": "7"})
    assert (s.api_key, s.max_concurrency, s.model_name, s.temperature) == ("k", 7, "", 0.3) and (tmp_path / "d").is_dir()
    assert pipeline.resolve_defaults("", "d", "title", "url", False) == ("d", "title", "url")
    assert pipeline.resolve_defaults("ft", pipeline.DEFAULT_DATASET, "title", "url", False) == (pipeline.SUBSET_DATASET, "id", "")
    assert pipeline.resolve_defaults("ft", pipeline.DEFAULT_DATASET, "navn", "link", True) == (pipeline.DEFAULT_DATASET, "navn", "link")


def test_source_columns_and_nulls(spark, tmp_path):
    spark.createDataFrame([(1, "t", None), (None, "u", "x"), (3, None, "y")], "id int, text string, url string").write.parquet(str(tmp_path / "s"))
    rows = sorted((r.text, r.title, r.url) for r in tables.read_source(spark, str(tmp_path / "s"), "text", "id", "url").na.fill("-").collect())
    assert rows == [("t", "1", "-"), ("u", "-", "x")]
    assert {r.url for r in tables.read_source(spark, str(tmp_path / "s"), "text", "none", "").collect()} == {""}


def test_jsonl_writes_nulls(spark, tmp_path):
    df = spark.createDataFrame([("æ", None)], "paragraph string, title string")
    tables.write_jsonl(df, str(tmp_path / "j"))
    assert '{"paragraph":"æ","title":null}' in "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert tables.enough(spark, str(tmp_path / "j"), 0) and tables.enough(spark, str(tmp_path / "j"), 1) and not tables.enough(spark, str(tmp_path / "j"), 2) and not tables.enough(spark, str(tmp_path / "k"), 0)


def test_run_everything_isolates_failures_and_resumes(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    r = random.Random(5)
    word = lambda: "".join(r.choice("bdfgklmnprstv") + r.choice("aeiouy") for _ in range(3))
    docs = [(f"d{i}", " ".join(f"{word().title()} og {word()} er en {word()} med {word()} {word()} {word()}." for _ in range(8))) for i in range(12)]
    spark.createDataFrame(docs, "id string, text string").coalesce(1).write.parquet(str(tmp_path / "data/egen/source.parquet"))
    assert tables.local_datasets(spark, str(tmp_path / "data"), fixed.RUN_SUBSETS) == ["egen"] and tables.local_datasets(spark, str(tmp_path / "none"), ()) == []
    report = pipeline.run_everything(spark, str(tmp_path / "data"), lambda d: settings.load_settings(d, 1.0, {}), names=("ft",))
    assert report["egen"] == "done" and report["ft"].startswith("failed")
    first = spark.read.parquet(str(tmp_path / "data/egen/final.parquet")).collect()
    assert len(first) >= 1 and [m.role for m in first[0].messages] == ["user", "assistant"]
    assert sorted(r.prompt_id for r in first) == sorted(f"prompt_{i}" for i in range(len(first)))
    n = spark.read.parquet(str(tmp_path / "data/egen/cache.parquet")).count()
    assert cli.main(["run-all", "-d", str(tmp_path / "data/egen"), "--subset", "egen"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "data/egen/cache.parquet")).count() == n
    assert spark.read.parquet(str(tmp_path / "data/egen/final.parquet")).count() == len(first)


def test_a_source_without_usable_text_goes_through_all_stages(spark, tmp_path, capsys):
    spark.createDataFrame([("kort",), (None,)], "text string").coalesce(1).write.parquet(str(tmp_path / "source.parquet"))
    for _ in range(2):
        pipeline.run_all(spark, settings.load_settings(str(tmp_path), 1.0, {}))
    assert spark.read.parquet(str(tmp_path / "final.parquet")).count() == 0
    assert "extract: 0 paragraphs of 1 documents with text" in capsys.readouterr().out


def test_options():
    o = cli.parser().parse_args(["extract", "--subset", "ft", "-n", "5", "--min-chars", "50"])
    assert (o.subset, o.n_samples, o.min_chars, o.max_chars, o.seed, o.data_dir) == ("ft", 5, 50, 3000, 42, "data")
    assert cli.parser().parse_args(["select"]).temperature == 0.3 and cli.parser().parse_args(["generate"]).temperature == 1.0


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    from corpusforge.streaming.incremental import extract_stream

    rows = [(PROSE.replace("Byen", w), "t", f"u{i}") for i, w in enumerate(("Havnen", "Skolen", "Kirken"))]
    src = str(tmp_path / "in")
    for r in rows:
        spark.createDataFrame([r], "text string, title string, url string").coalesce(1).write.mode("append").parquet(src)
        q = extract_stream(spark, src, str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination(60)
    got = sorted(r.paragraph for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted(r.paragraph for r in stages.extract(spark.read.parquet(src), None, False).collect())
    assert got == want and len(got) == 3


def test_entry_and_plan(spark, data):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns[2] == "paragraph" and df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["filter_wiki", "rule_doubled", "postprocess"])
def test_queries_match_sql(spark, data, name):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    for t in ("paragraphs", "with_instructions", "documents", "selected"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = e.queries()[name](spark, data)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({e.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, want))
