"""Registered queries of the training-data operators: name -> (spark, data folder) -> DataFrame, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import markup, mixing, packing, pairs, quality, readability, sitelines, tokens, truncation
from .common import plain_source, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    q = quality.quality(table(spark, d, "paragraphs"))
    return q.where(F.col("kind").isin("list", "table", "junk") & F.col("paragraph_id").isNotNull()).groupBy("paragraph_id").agg(F.min("kind").alias("kind"))


def p1_quality(spark: SparkSession, d: str) -> DataFrame:
    q = quality.quality(table(spark, d, "paragraphs"))
    z = [f"z_{s}" for s in quality.STATS]
    return q.select("paragraph_id", "lang", "words", *quality.STATS, *z, F.array_join("flags", ",").alias("flags"), "kind").dropDuplicates(["paragraph_id"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.markup_found(table(spark, d, "paragraphs"))


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.cleaned(table(spark, d, "paragraphs")).dropDuplicates(["paragraph_id"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defective_pairs(table(spark, d, "with_instructions"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "with_instructions")
    source = w.select("pair_id", plain_source(F.col("source_type"), "knowledge").alias("source_type")).dropDuplicates(["pair_id"])
    return pairs.defective_pairs(w).join(source, "pair_id").groupBy("source_type", "defect").agg(F.count("*").alias("pairs"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    places, _ = sitelines.boilerplate(table(spark, d, "paragraphs"))
    return places.select(F.col("doc").alias("paragraph_id"), F.col("line_no").cast("int").alias("line_no")).distinct()


def p4_blocks(spark: SparkSession, d: str) -> DataFrame:
    _, blocks = sitelines.boilerplate(table(spark, d, "paragraphs"))
    return sitelines.named_blocks(blocks)


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "paragraphs")
    places, _ = sitelines.boilerplate(t)
    return sitelines.clean(t, places)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "selected")).where("cut").select("selected_id")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    t = truncation.truncated(table(spark, d, "selected"))
    return t.groupBy(F.col("source").alias("source_type")).agg(
        F.count("*").alias("passages"), F.sum(F.col("cut").cast("long")).alias("cut"), F.avg(F.col("cut").cast("double")).alias("cut_share"), F.avg((F.col("posterior") > 0.5).cast("double")).alias("at_limit_share")
    )


def p6_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.with_slice_totals(tokens.counted(table(spark, d, "selected"), "selected_id", "paragraph", tokens.slices(), tokens.vocabulary_path(spark)), "selected_id")


def p6_budget(spark: SparkSession, d: str) -> DataFrame:
    return tokens.budget(table(spark, d, "selected"), path=tokens.vocabulary_path(spark))


def _packed(spark: SparkSession, d: str, joint: bool) -> DataFrame:
    profiles = packing.read_profiles(table(spark, d, "pack_profiles"))
    plan = [("joint", [c for _, c in profiles])] if joint else [(name, [c]) for name, c in profiles]
    return packing.containers(table(spark, d, "documents"), plan, path=tokens.vocabulary_path(spark), attention=packing.ATTENTION if joint else 0)


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d, False)


def p7_joint(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d, True)


def p7_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(_packed(spark, d, False)).unionByName(packing.usage(_packed(spark, d, True)))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"), path=tokens.vocabulary_path(spark))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"), path=tokens.vocabulary_path(spark))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    r = readability.reading_levels(table(spark, d, "documents"), table(spark, d, "reader_levels"))
    return r.where(F.col("level").isin("easy", "hard")).select("doc_id", "level")


def p9_levels(spark: SparkSession, d: str) -> DataFrame:
    r = readability.reading_levels(table(spark, d, "documents"), table(spark, d, "reader_levels"))
    return r.select("doc_id", "words", "sentences", "mean_sentence", "mean_word", "long_share", "lang", *readability.COVERS, "grade", "level")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_quality, p2_found, p2_clean, p3_found, p3_report, p4_found, p4_blocks, p4_clean, p5_found, p5_report, p6_tokens, p6_budget,
        p7_joint, p7_pack, p7_usage, p8_mix, p8_shares, p9_found, p9_levels,
    )
}
