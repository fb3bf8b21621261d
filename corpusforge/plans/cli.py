"""Command line: ``python -m corpusforge.plans.cli COMMAND``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..sources.settings import load_settings
from . import pipeline as p


def parser() -> argparse.ArgumentParser:
    a = argparse.ArgumentParser(prog="corpusforge", description="Instruction-tuning records from human-written text.")
    sub = a.add_subparsers(dest="command", required=True)

    def source(c: argparse.ArgumentParser) -> None:
        c.add_argument("--dataset", default=p.DEFAULT_DATASET, help="path of the parquet source, unless the data folder holds one")
        c.add_argument("--subset", default="")
        c.add_argument("--text-column", dest="text", default="text")
        c.add_argument("--title-column", dest="title", default="title")
        c.add_argument("--url-column", dest="url", default="url")

    def extraction(c: argparse.ArgumentParser) -> None:
        c.add_argument("-n", "--n-samples", type=int, default=0)
        c.add_argument("--seed", type=int, default=42)
        c.add_argument("--min-chars", type=int, default=100)
        c.add_argument("--max-chars", type=int, default=3000)
        c.add_argument("--streaming", action="store_true", help="accepted for compatibility: scans are lazy and partitioned anyway")

    for name, temperature in (("extract", None), ("select", 0.3), ("generate", 1.0), ("postprocess", None), ("run-all", 1.0)):
        c = sub.add_parser(name)
        c.add_argument("-d", "--data-dir", default="data")
        if name in ("extract", "run-all"):
            source(c)
            extraction(c)
        if temperature is not None:
            c.add_argument("-t", "--temperature", type=float, default=temperature)
        if name == "run-all":
            c.add_argument("--select-temperature", type=float, default=0.3)
    c = sub.add_parser("run-everything")
    extraction(c)
    c.add_argument("-t", "--temperature", type=float, default=1.0)
    c.add_argument("--select-temperature", type=float, default=0.3)
    c.add_argument("--data-root", default="data")
    return a


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    o = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusforge").getOrCreate()
    if o.command == "run-everything":
        report = p.run_everything(
            spark, o.data_root, lambda d: load_settings(d, o.temperature), select_temperature=o.select_temperature,
            n_samples=o.n_samples, seed=o.seed, min_chars=o.min_chars, max_chars=o.max_chars,
        )
        print("\n".join(f"{k}: {v}" for k, v in report.items()))
        return 0
    s = load_settings(o.data_dir, getattr(o, "temperature", 1.0) or 0.0)
    options = {k: getattr(o, k) for k in ("dataset", "subset", "text", "title", "url", "n_samples", "seed", "min_chars", "max_chars") if hasattr(o, k)}
    if o.command == "extract":
        p.run_extract(spark, s, **options)
    elif o.command == "select":
        p.run_select(spark, s)
    elif o.command == "generate":
        p.run_generate(spark, s)
    elif o.command == "postprocess":
        p.run_postprocess(spark, s)
    else:
        p.run_all(spark, s, o.select_temperature, **options)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
