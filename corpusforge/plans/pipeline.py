"""Running stages from folder to folder, for one dataset or for all."""

from __future__ import annotations

import traceback
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import DEFAULT_TYPE, RUN_SUBSETS, SUBSET_TYPES
from ..operators import instruct
from ..operators.completion import Completer, HttpCompleter, StubCompleter
from ..operators.split import is_wiki_like
from ..sources import shared, tables
from ..sources.settings import Settings
from . import stages

DEFAULT_DATASET, SUBSET_DATASET = "danish_wikipedia", "danish_subsets"


def resolve_defaults(subset: str, dataset: str, title: str, url: str, has_local: bool) -> tuple[str, str, str]:
    """(dataset, title column, url column) with the defaults of a named subset: the corpus of subsets unless a local source is
    there, ids as titles and no url."""
    if not subset:
        return dataset, title, url
    if dataset == DEFAULT_DATASET and not has_local:
        dataset = SUBSET_DATASET
    return dataset, "id" if title == "title" else title, "" if url == "url" else url


def completer_of(s: Settings, kind: str) -> Completer:
    """The service of the settings, or the offline stand-in without one."""
    return HttpCompleter(s.base_url, s.api_key, s.model_name, s.temperature) if s.base_url else StubCompleter(kind)


def _stage(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stage's file with the order of the source (null for a file that lacks it)."""
    tables.recover(spark, path)
    return tables.read_jsonl(spark, path, tables.with_order(schema))


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows of ``df`` are counted while they are written, without a second run."""
    o = Observation(name)
    return df.observe(o, F.count("*").alias("rows")), o


def _removed(before: int, after: int) -> str:
    return f"{after} kept, {before - after} removed ({100 * (before - after) / max(before, 1):.1f} %)"


def run_extract(spark: SparkSession, s: Settings, dataset: str = DEFAULT_DATASET, subset: str = "", text: str = "text", title: str = "title", url: str = "url", n_samples: int = 0, seed: int = 42, min_chars: int = 100, max_chars: int = 3000) -> str:
    out = f"{s.data_dir}/paragraphs.jsonl"
    if tables.enough(spark, out, n_samples):
        return out
    has_local = tables.exists(spark, f"{s.data_dir}/{tables.SOURCE_FILE}")
    dataset, title, url = resolve_defaults(subset, dataset, title, url, has_local)
    path = tables.source_path(spark, s.data_dir, f"{dataset}/{subset}" if subset else dataset)
    docs = tables.read_source(spark, path, text, title, url)
    kind = SUBSET_TYPES.get(subset, DEFAULT_TYPE)
    docs, read = _counted(docs, "documents")
    rows, written = _counted(stages.extract(docs, "doc_seq", is_wiki_like(dataset, subset), kind, min_chars, max_chars, n_samples, seed), "paragraphs")
    tables.write_jsonl(rows.select(*tables.with_order(tables.PARAGRAPH).fieldNames()), out)
    sampled = f" (a sample of {n_samples})" if n_samples else ""
    print(f"extract: {written.get['rows']} paragraphs{sampled} of {read.get['rows']} documents with text")
    return out


def run_select(spark: SparkSession, s: Settings, completer: Completer | None = None) -> str:
    out = f"{s.data_dir}/selected.jsonl"
    with shared.scope():
        docs = _stage(spark, f"{s.data_dir}/paragraphs.jsonl", tables.PARAGRAPH)
        tables.recover(spark, out)
        done = _stage(spark, out, tables.SELECTED) if tables.exists(spark, out) else None
        rows, counts = stages.select_passages(docs, done, completer or completer_of(s, "select"), f"{s.data_dir}/cache.parquet", s.model_name, s.temperature, s.max_concurrency)
        rows, total = _counted(rows, "selected")
        tables.replace_jsonl(rows.select(*tables.with_order(tables.SELECTED).fieldNames()), out)
        by = {r.verdict: r.rows for r in counts.collect()}  # five verdicts
        print(f"select: {total.get['rows']} passages in all; of the new ones {', '.join(f'{v} {by.get(v, 0)}' for v in stages.VERDICTS)}")
    return out


def run_generate(spark: SparkSession, s: Settings, completer: Completer | None = None) -> str:
    out = f"{s.data_dir}/with_instructions.jsonl"
    with shared.scope():
        docs, asked = _counted(_stage(spark, f"{s.data_dir}/selected.jsonl", tables.SELECTED), "passages")
        tables.recover(spark, out)
        done = _stage(spark, out, tables.INSTRUCTED) if tables.exists(spark, out) else None
        rows = stages.generate(docs, done, completer or completer_of(s, "generate"), f"{s.data_dir}/cache.parquet", s.model_name, s.temperature, s.max_concurrency)
        rows, total = _counted(rows, "pairs")
        tables.replace_jsonl(rows.select(*tables.with_order(tables.INSTRUCTED).fieldNames()), out)
        print(f"generate: {total.get['rows']} of {asked.get['rows']} passages have an instruction, {max(0, asked.get['rows'] - total.get['rows'])} failed or are not Danish")
    return out


def run_postprocess(spark: SparkSession, s: Settings) -> str:
    with shared.scope():
        docs = _stage(spark, f"{s.data_dir}/with_instructions.jsonl", tables.INSTRUCTED)
        usable = F.count_if(instruct.usable(F.col("instruction"), F.col("paragraph")))
        loaded = Observation("pairs")
        docs = shared.materialise(docs.observe(loaded, F.count("*").alias("rows"), usable.alias("usable")), "pairs")
        final, passes = stages.postprocess(docs, tables.ORDER.fieldNames(), s.minhash_threshold, s.num_perm, vocabulary=s.dedup_vocabulary)
        tables.write_parquet(final, f"{s.data_dir}/final.parquet")
        first, second = (p.count() for p in passes)  # of tables that are written already
        n = loaded.get
        print(f"postprocess: {n['rows']} pairs; refusals: {_removed(n['rows'], n['usable'])}; near-duplicate instructions: {_removed(n['usable'], first)}; near-duplicate answers: {_removed(first, second)}")
    tables.write_jsonl(spark.read.parquet(f"{s.data_dir}/final.parquet"), f"{s.data_dir}/final.jsonl")
    return f"{s.data_dir}/final.parquet"


def run_all(spark: SparkSession, s: Settings, select_temperature: float = 0.3, select: Completer | None = None, generate: Completer | None = None, **options) -> str:
    from dataclasses import replace

    run_extract(spark, s, **options)
    run_select(spark, replace(s, temperature=select_temperature), select)
    run_generate(spark, s, generate)
    return run_postprocess(spark, s)


def run_everything(spark: SparkSession, root: str, settings: Callable[[str], Settings], names: tuple[str, ...] = RUN_SUBSETS, **options) -> dict[str, str]:
    """All registered subsets, then the local datasets found, each in its own folder; a failure is reported and the rest goes on."""
    report = {}
    for name in [*names, *tables.local_datasets(spark, root, names)]:
        try:
            run_all(spark, settings(f"{root.rstrip('/')}/{name}"), subset=name, **options)
            report[name] = "done"
        except Exception as e:  # noqa: BLE001 - one dataset's failure must not end the run
            traceback.print_exc()
            report[name] = f"failed: {type(e).__name__}"
    return report
