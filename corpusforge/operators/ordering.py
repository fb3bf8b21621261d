"""Samples, global random order and dense row numbers, without sorting everything on one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import materialise


def shuffle_key(seed: int, *cols: Column | str) -> Column:
    """A hash that orders rows at random, the same in every engine: hex MD5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]))


def sampled(df: DataFrame, n: int, seed: int, *key: Column | str) -> DataFrame:
    """``n`` rows at random without replacement (all if n is 0): each task keeps its first n, the driver plan merges them."""
    return df if n <= 0 else df.withColumn("_h", shuffle_key(seed, *key)).orderBy("_h", *key).limit(n).drop("_h")


#: Rows that one task sorts when rows are numbered.
RANGE_ROWS = 1_000_000


def range_digits(rows: int, range_rows: int = RANGE_ROWS) -> int:
    """Hex digits of the hash that make ranges of ``range_rows`` or fewer rows on average: three to six."""
    return next((k for k in range(3, 6) if rows <= range_rows * 16**k), 6)


def numbered(df: DataFrame, seed: int, *key: Column | str, name: str = "row_no", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds the position (from 0) of each row in random order. Rows are written once, then numbered within ranges of the
    hash's first digits, as many as the rows need; the sizes of the ranges (a small table) give the offsets, so no task
    holds more than its range. Of the rows of one key any order is taken."""
    d = materialise(df.withColumn("_h", shuffle_key(seed, *key)), "numbered")
    d = d.withColumn("_b", F.substring("_h", 1, range_digits(d.count(), range_rows)))
    sizes = d.groupBy("_b").agg(F.count("*").alias("_n"))
    w = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)  # a row for each range: 16^6 at most
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    inner = F.row_number().over(W.partitionBy("_b").orderBy("_h", *key)) - 1
    return d.withColumn("_i", inner).join(offsets, "_b").withColumn(name, F.col("_off") + F.col("_i")).drop("_h", "_b", "_i", "_off")
