"""The four stages as functions from DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions.fixed import DEFAULT_TYPE
from ..sources.shared import materialise
from ..sources.tables import ORDER
from ..operators import clean, dedup, instruct, ordering, resume, rules, split, verbatim
from ..operators.completion import Completer, completed

FINAL_COLUMNS = ("prompt_id", "messages", "title", "url", "section_heading")


#: What becomes of a response in stage 2.
VERDICTS = ("kept", "skip", "short", "verify", "fail")


def _order_of(docs: DataFrame) -> list[str]:
    return [c for c in ORDER.fieldNames() if c in docs.columns]


def extract(docs: DataFrame, order: str | None, wiki: bool, source_type: str | Column = DEFAULT_TYPE, min_chars: int = 100, max_chars: int = 3000, n_samples: int = 0, seed: int = 42) -> DataFrame:
    """Stage 1 over (text, title, url): split, clean, filter. One narrow plan without any shuffle (but for a sample).
    ``order`` names the column of the documents' order, kept as ``doc_seq`` with ``chunk_idx``; without one the hash of the
    document stands in. A null or empty url is taken from the text's ``Kilde:`` line."""
    seq = F.col(order) if order else F.xxhash64("text", "title", "url")
    d = docs.where("text is not null").select(
        seq.alias("doc_seq"), "text", "title", F.when(F.coalesce("url", F.lit("")) == "", clean.metadata_url(F.col("text"))).otherwise(F.col("url")).alias("url")
    )
    parts = split.explode_parts(d, "text", wiki, max_chars).drop("text").withColumn("_clean", clean.cleaned(F.col("paragraph"))).drop("paragraph")
    kept = rules.judged(parts, wiki, "_clean", min_chars, max_chars).where("verdict = 'kept'")
    kind = F.lit(source_type) if isinstance(source_type, str) else source_type
    out = kept.select("doc_seq", "chunk_idx", "paragraph", "title", "url", "section_heading", kind.alias("source_type"))
    return ordering.sampled(out, n_samples, seed, "doc_seq", "chunk_idx")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[c for c in docs.columns if c not in ("title", "url", "section_heading", "source_type")], *[
        (F.coalesce(F.col(c), F.lit(d)) if c in docs.columns else F.lit(d)).alias(c) for c, d in (("title", ""), ("url", ""), ("section_heading", ""), ("source_type", DEFAULT_TYPE))
    ])


def select_passages(docs: DataFrame, done: DataFrame | None, completer: Completer, cache_path: str, model: str = "", temperature: float = 0.3, max_concurrency: int = 50) -> tuple[DataFrame, DataFrame]:
    """Stage 2: (all selected so far, counts of the new ones' verdicts). The judged rows are written once; the order of the
    source stays with them."""
    d = _texts(docs)
    if done is not None:
        d = resume.remaining(d, done, "paragraph", "original_paragraph")
    d = d.withColumn("prompt", instruct.rendered(prompts.SELECT, F.col("source_type"), DEFAULT_TYPE, F.col("paragraph")))
    r = completed(d, completer, prompts.SELECT_SYSTEM, model, temperature, cache_path, max_concurrency)
    judged = verbatim.verbatim(r, "paragraph", "response").withColumn("verdict", instruct.select_verdict(F.col("response"), F.col("verbatim")))
    judged = materialise(judged.drop("prompt", "verbatim"), "judged")
    new = judged.where("verdict = 'kept'").select(
        instruct.strip(F.col("response")).alias("paragraph"), F.col("paragraph").alias("original_paragraph"), "title", "url", "section_heading", "source_type", *_order_of(docs)
    )
    counts = judged.groupBy("verdict").agg(F.count("*").alias("rows"))
    return (new if done is None else resume.appended(done, new)), counts


def template_of(source_type: Column, text: Column) -> Column:
    """Name of the instruction template: the source type (an unknown one is the default) and the format of the text."""
    kind = F.coalesce(source_type, F.lit(DEFAULT_TYPE))
    return F.concat_ws("|", F.when(kind.isin(*prompts.SELECT), kind).otherwise(F.lit(DEFAULT_TYPE)), instruct.format_choice(text))


def generate(docs: DataFrame, done: DataFrame | None, completer: Completer, cache_path: str, model: str = "", temperature: float = 1.0, max_concurrency: int = 50) -> DataFrame:
    """Stage 3: adds ``instruction``; rows without a Danish one are left out (and tried again in a later run)."""
    d = docs if done is None else resume.remaining(docs, done, "paragraph", "paragraph")
    d = d.withColumn("prompt", instruct.rendered(prompts.GENERATE, template_of(F.col("source_type"), F.col("paragraph")), f"{DEFAULT_TYPE}|A", F.col("paragraph")))
    r = completed(d, completer, prompts.GENERATE_SYSTEM, model, temperature, cache_path, max_concurrency).where("coalesce(response, '') <> ''")
    new = r.withColumn("instruction", instruct.without_label(F.col("response"))).where(instruct.looks_danish(F.col("instruction"))).drop("prompt", "response")
    return new if done is None else resume.appended(done, new)


def postprocess(docs: DataFrame, order: list[str], threshold: float = 0.7, num_perm: int = 128, seed: int = 42, prefix: str = "prompt_", vocabulary: str = "") -> tuple[DataFrame, list[DataFrame]]:
    """Stage 4: refusals out, near-duplicates out by instruction and then by answer (the first in ``order`` stays; identical
    rows are one), random order, chat records. Returns them and the rows kept by the two passes."""
    d = docs.where(instruct.usable(F.col("instruction"), F.col("paragraph")))
    d, passes = dedup.without_near_duplicates(d, order, ["instruction", "paragraph"], threshold, num_perm, vocabulary)
    placeless = F.lit(True)
    for c in order:
        placeless = placeless & F.col(c).isNull()
    n = ordering.numbered(_texts(d), seed, *order, *[F.when(placeless, F.col(c)) for c in dedup.ROW])
    out = n.select(F.concat(F.lit(prefix), F.col("row_no").cast("string")).alias("prompt_id"), instruct.chat(F.col("instruction"), F.col("paragraph")).alias("messages"), "title", "url", "section_heading")
    return out, passes
