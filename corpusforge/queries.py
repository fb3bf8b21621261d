"""Registered queries of the pipeline's operators: name -> (spark, data folder) -> DataFrame, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed, prompts
from .functions.text import split_lines, squeezed
from .operators import clean, completion, dedup, instruct, ordering, resume, rules, split, verbatim
from .operators.completion import StubCompleter
from .plans import pipeline, stages
from .sources import cache, settings, tables
from .sources.shared import materialise, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ------------------------------------------------------------------ splitting and cleaning

@query
def split_generic(spark: SparkSession, d: str) -> DataFrame:
    return split.explode_parts(table(spark, d, "documents").select("doc_id", "text"), "text", False).select("doc_id", "chunk_idx", "paragraph")


@query
def split_sections(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "paragraphs").select("paragraph_id", "paragraph").withColumnRenamed("paragraph", "text")
    return split.explode_parts(p, "text", True).select("paragraph_id", "chunk_idx", "section_heading", "paragraph")


@query
def split_sentences(spark: SparkSession, d: str) -> DataFrame:
    return split.exploded(table(spark, d, "documents").select("doc_id", split.sentences(F.col("text")).alias("a")), "a", "pos", "sentence")


@query
def merge_blocks(spark: SparkSession, d: str) -> DataFrame:
    m = split.merged(split_lines(F.col("text")), 500, F.lit("\n"))
    return split.exploded(table(spark, d, "documents").select("doc_id", m.alias("a")), "a", "pos", "block")


@query
def clean_paragraph(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", clean.cleaned(F.col("text")).alias("cleaned"))


@query
def metadata_url(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\nKilde: "), F.col("url"), F.lit(" "))).otherwise(F.lit("\nKilde:x\nPubliceret: 2024-01-02")))
    return table(spark, d, "documents").select("doc_id", clean.metadata_url(t).alias("found_url"), clean.metadata_url(F.col("text")).alias("own_url"))


# ------------------------------------------------------------------ rules

def _rule(name: str, rule: Callable[[], object]) -> None:
    def q(spark: SparkSession, d: str) -> DataFrame:
        return rules.with_parts(table(spark, d, "paragraphs")).select("paragraph_id", rule().alias("rejected"))

    QUERIES[f"rule_{name}"] = q


for _name, _f in (
    ("heading", rules.heading), ("length", rules.length), ("list", rules.mostly_list), ("links", rules.links), ("stub", rules.stub), ("years", rules.years), ("sentences", rules.few_sentences),
    ("foreign_script", rules.foreign_script), ("doubled", rules.doubled), ("stray", rules.stray), ("corrupted", rules.corrupted), ("quotes", rules.quotes), ("boilerplate", rules.boilerplate), ("old_spelling", rules.old_spelling),
):
    _rule(_name, _f)


@query
def filter_generic(spark: SparkSession, d: str) -> DataFrame:
    return rules.judged(table(spark, d, "paragraphs"), False).select("paragraph_id", "verdict")


@query
def filter_wiki(spark: SparkSession, d: str) -> DataFrame:
    return rules.judged(table(spark, d, "paragraphs"), True).select("paragraph_id", "verdict")


@query
def reject_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.judged(table(spark, d, "paragraphs"), True).groupBy("verdict").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ stage 1

@query
def extract_generic(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "title", "url")
    return stages.extract(docs, "doc_id", False)


@query
def extract_wiki(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", r"(?m)^# ", "## ").alias("text"), "title", "url")
    return stages.extract(docs, "doc_id", True)


@query
def extract_sample(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "title", "url")
    return stages.extract(docs, "doc_id", False, n_samples=100).select("doc_seq", "chunk_idx")


# ------------------------------------------------------------------ stages 2 and 3

@query
def source_types(spark: SparkSession, d: str) -> DataFrame:
    s = F.element_at(F.array(*[F.lit(k) for k in (*fixed.SUBSET_TYPES, "other")]), (F.pmod("doc_id", F.lit(8)) + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", s.alias("subset"), instruct.source_type(s).alias("source_type"), instruct.source_type(F.col("source")).alias("own_type"))


@query
def format_choice(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "selected").where("paragraph is not null").select("selected_id", instruct.format_choice(F.col("paragraph")).alias("format"))


@query
def render_prompt(spark: SparkSession, d: str) -> DataFrame:
    p = instruct.rendered({k: v for k, v in prompts.SELECT.items()}, F.col("source_type"), "knowledge", F.col("paragraph"))
    return table(spark, d, "paragraphs").select("paragraph_id", p.alias("prompt"))


@query
def label_strip(spark: SparkSession, d: str) -> DataFrame:
    i = F.when(F.col("pair_id") % 3 == 0, F.concat(F.lit(" Format C\n\n"), F.col("instruction"))).otherwise(F.col("instruction"))
    return table(spark, d, "with_instructions").select("pair_id", instruct.without_label(i).alias("instruction"), instruct.without_label(F.col("instruction")).alias("own"))


@query
def looks_danish(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", instruct.looks_danish(F.col("text")).alias("danish"))


@query
def refusal_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "with_instructions").where(instruct.usable(F.col("instruction"), F.col("paragraph"))).select("pair_id", "instruction")


@query
def normalised_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", squeezed(F.col("text")).alias("squeezed"))


@query
def verbatim_fast(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "selected").select("selected_id", verbatim.contained(F.col("original_paragraph"), F.col("paragraph")).alias("contained"))


@query
def verbatim_full(spark: SparkSession, d: str) -> DataFrame:
    return verbatim.verbatim(table(spark, d, "selected"), "original_paragraph", "paragraph").select("selected_id", "verbatim")


@query
def select_verdicts(spark: SparkSession, d: str) -> DataFrame:
    r = F.when(F.col("selected_id") % 7 == 0, F.lit(" skip\n")).when(F.col("selected_id") % 11 == 0, F.lit("")).otherwise(F.col("paragraph"))
    c = verbatim.contained(F.col("original_paragraph"), F.col("paragraph"))
    return table(spark, d, "selected").select("selected_id", instruct.select_verdict(r, c).alias("verdict"), instruct.select_verdict(F.col("paragraph"), c).alias("own"))


@query
def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    docs, done = table(spark, d, "paragraphs"), table(spark, d, "selected")
    return resume.remaining(docs, done, "paragraph", "original_paragraph").select("paragraph_id")


@query
def append_done(spark: SparkSession, d: str) -> DataFrame:
    done, new = table(spark, d, "selected"), table(spark, d, "paragraphs")
    return resume.appended(done.select("paragraph", "source_type"), new.select("paragraph", "source_type", "title"))


@query
def cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "with_instructions")
    store = w.where("paragraph is not null").select(F.sha2(F.col("paragraph").cast("binary"), 256).alias("key"), F.col("instruction").alias("response"))
    asked = table(spark, d, "selected").select("selected_id", F.sha2(F.col("paragraph").cast("binary"), 256).alias("key"))
    return cache.lookup(asked, store).select("selected_id", "response")


@query
def select_stage(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "paragraphs").select("paragraph", "title", "url", "section_heading", F.lower(F.trim("source_type")).alias("source_type")).where("paragraph is not null")
    return stages.select_passages(docs, None, StubCompleter("select"), scratch(spark, "cache"))[0]


@query
def generate_stage(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "selected").select("paragraph", "original_paragraph", "title", "url", "section_heading", F.lower(F.trim("source_type")).alias("source_type")).where("paragraph is not null")
    return stages.generate(docs, None, StubCompleter("generate"), scratch(spark, "cache"))


# ------------------------------------------------------------------ stage 4

@query
def lsh_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_of_their_kind(table(spark, d, "documents"), ["doc_id"], "text")


@query
def lsh_dedup_instructions(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_of_their_kind(table(spark, d, "with_instructions"), ["pair_id"], "instruction")


@query
def sample_n(spark: SparkSession, d: str) -> DataFrame:
    return ordering.sampled(table(spark, d, "documents").select("doc_id", "title"), 50, 42, "doc_id")


@query
def shuffle_ids(spark: SparkSession, d: str) -> DataFrame:
    return ordering.numbered(table(spark, d, "documents").select("doc_id"), 42, "doc_id")


@query
def chat_format(spark: SparkSession, d: str) -> DataFrame:
    m = instruct.chat(F.col("instruction"), F.col("paragraph"))
    return table(spark, d, "with_instructions").select("pair_id", F.inline(m)).withColumnsRenamed({"content": "content", "role": "role"})


@query
def postprocess(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "with_instructions").select("pair_id", "instruction", "paragraph", "title", "url", "section_heading", "source_type")
    f, _ = stages.postprocess(w, ["pair_id"])
    return f.select("prompt_id", F.col("messages")[0]["content"].alias("instruction"), F.col("messages")[1]["content"].alias("answer"))


@query
def lsh_dedup_pieces(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_of_their_kind(table(spark, d, "documents"), ["doc_id"], "text", vocabulary=settings.path_of(spark, "corpusforge.tokenizer", settings.VOCABULARY))


@query
def pipeline_e2e(spark: SparkSession, d: str) -> DataFrame:
    p = materialise(extract_generic(spark, d), "paragraphs")  # as the stages' files are
    s = materialise(stages.select_passages(p, None, StubCompleter("select"), scratch(spark, "cache"))[0], "selected")
    g = materialise(stages.generate(s, None, StubCompleter("generate"), scratch(spark, "cache")), "pairs")
    f, _ = stages.postprocess(g, ["doc_seq", "chunk_idx"])
    return f.select("prompt_id", F.col("messages")[0]["content"].alias("instruction"), F.col("messages")[1]["content"].alias("answer"), "title", "url", "section_heading")


@query
def generate_prompt(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "selected").where("paragraph is not null")
    kind = F.lower(F.trim("source_type"))
    p = instruct.rendered(prompts.GENERATE, stages.template_of(kind, F.col("paragraph")), f"{fixed.DEFAULT_TYPE}|A", F.col("paragraph"))
    return t.select("selected_id", F.lit(prompts.GENERATE_SYSTEM).alias("system"), p.alias("prompt"))


@query
def cache_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "with_instructions").select("pair_id", cache.cache_key("m", 0.3, prompts.SELECT_SYSTEM, F.coalesce("instruction", F.lit(""))).alias("key"))


@query
def completion_map(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "selected").where("paragraph is not null").select("selected_id", F.col("paragraph").alias("prompt"))
    return completion.completed(asked, StubCompleter("generate"), "", "m", 1.0, scratch(spark, "cache")).select("selected_id", "response")


@query
def resume_generate(spark: SparkSession, d: str) -> DataFrame:
    return resume.remaining(table(spark, d, "selected"), table(spark, d, "with_instructions"), "paragraph", "paragraph").select("selected_id")


@query
def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "with_instructions").select("pair_id", "instruction", "paragraph", "title", "url", "section_heading", "source_type")
    usable = w.where(instruct.usable(F.col("instruction"), F.col("paragraph")))
    _, passes = dedup.without_near_duplicates(usable, ["pair_id"], ["instruction", "paragraph"])
    steps = (("loaded", w), ("usable", usable), ("instructions", passes[0]), ("answers", passes[1]))
    one = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("step"), "rows") for n, t in steps]
    return one[0].unionAll(one[1]).unionAll(one[2]).unionAll(one[3])


@query
def resolve_defaults(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.explode(F.array(*[F.lit(x) for x in ("", "ft")])).alias("subset"))
    rows = [(s, *pipeline.resolve_defaults(s, pipeline.DEFAULT_DATASET, "title", "url", False)) for s in ("", "ft")]
    return t.join(spark.createDataFrame(rows, "subset string, dataset string, title string, url string"), "subset")


@query
def parquet_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "parquet")
    tables.write_parquet(table(spark, d, "paragraphs").select("paragraph_id", "paragraph", F.lower(F.trim("source_type")).alias("source_type")), path, "source_type")
    return spark.read.parquet(path)


@query
def source_discovery(spark: SparkSession, d: str) -> DataFrame:
    root = scratch(spark, "sources")
    for name in ("ft", "egen", "anden"):
        tables.write_parquet(table(spark, d, "region"), f"{root}/{name}/{tables.SOURCE_FILE}")
    found = [(n, tables.source_path(spark, f"{root}/{n}", "remote").endswith(tables.SOURCE_FILE)) for n in tables.local_datasets(spark, root, ("ft",))]
    return spark.createDataFrame([*found, ("none", tables.source_path(spark, f"{root}/none", "remote") != "remote")], "name string, local boolean")


@query
def skip_done(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "done")
    tables.write_jsonl(table(spark, d, "region"), path)  # five rows
    return spark.createDataFrame([(n, tables.enough(spark, path, n), tables.enough(spark, path + "-none", n)) for n in (0, 1, 5, 6)], "n int, there boolean, missing boolean")


@query
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    tables.write_jsonl(table(spark, d, "paragraphs").select(*tables.PARAGRAPH.fieldNames()), path)
    return tables.read_jsonl(spark, path, tables.PARAGRAPH)


@query
def source_scan(spark: SparkSession, d: str) -> DataFrame:
    return tables.read_source(spark, f"{d}/documents.parquet", "text", "doc_id", "url").drop("doc_seq")
