"""Resuming a stage: what is done already, and the union of old and new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remaining(docs: DataFrame, done: DataFrame, key: str, done_key: str) -> DataFrame:
    """Rows whose ``key`` is not among ``done_key`` (rows with a null key stay). Long texts are compared by a 128-bit hash, so
    the texts done before are not shuffled."""
    h = lambda c: [F.xxhash64(c).alias("_h1"), F.xxhash64(F.lit(1), c, F.length(c)).alias("_h2")]
    seen = done.where(F.col(done_key).isNotNull()).select(*h(F.col(done_key))).distinct()
    marked = docs.select("*", *[F.when(F.col(key).isNotNull(), c).alias(n) for c, n in zip(h(F.col(key)), ("_h1", "_h2"))])
    return marked.join(seen, ["_h1", "_h2"], "left_anti").drop("_h1", "_h2")


def appended(done: DataFrame, new: DataFrame) -> DataFrame:
    """Both, nothing removed; a column that one side lacks is null there."""
    return done.unionByName(new, allowMissingColumns=True)
