"""Problem 8: mixing sources to target weights.

Method: hash-threshold histograms. Tokens are summed by source and bucket of the document's hash; a running sum over the
buckets finds the threshold of each budget; only the bucket on the boundary is refined, by the next bits of the hash,
and documents are then chosen by a comparison of hashes, without sorting. Thresholds are nested: a smaller budget's
documents are among a larger one's, in every mix.

For a mix, T is the total wanted (by default the tokens its sources hold). A source with supply S and target share w has
the budget w*T, at most max_repeats*S: every document is used floor(budget/S) times, and those below the threshold once
more. A source too small for its share is used max_repeats times and no other source takes its place, so that the others
keep their proportions; the shares reached are reported. Histograms have at most 4096 rows a source, targets are few by
their nature (broadcast only if no more than FEW_TARGETS); neither is collected. Rows without key or source, and sources in no mix, are left out; a repeated key
counts once; documents of 0 tokens are used like the rest of their hash range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, plain_source
from .tokens import VOCABULARY, sizes

BITS, LEVELS, WIDTH = 60, 3, 12
#: Targets up to this number are broadcast; more meet the documents in a join salted by document.
FEW_TARGETS, SALTS = 10_000, 32


def hashed(key: Column) -> Column:
    """60 bits of the key's hash."""
    return F.xxhash64(key, F.lit(42)).bitwiseAND((1 << BITS) - 1)


def bucket(level: int) -> Column:
    """Bits of the hash that number the buckets of one level."""
    return F.shiftrightunsigned(F.col("h"), BITS - WIDTH * (level + 1)).bitwiseAND((1 << WIDTH) - 1)


def budgets(supply: DataFrame, targets: DataFrame, total_tokens: int | None) -> DataFrame:
    """(mix, source, target_share, max_repeats, supply, docs, wanted, passes, rest) for each target."""
    t = targets.where("mix is not null and source is not null").select(
        "mix", plain_source(F.col("source"), "unknown").alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats")
    ).groupBy("mix", "source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    j = t.join(supply, "source", "left").na.fill(0, ["supply", "docs"])
    total = F.lit(float(total_tokens)) if total_tokens else F.sum("supply").over(W.partitionBy("mix")).cast("double")  # a mix's few targets
    j = j.withColumn("wanted", total * F.col("target_share"))
    use = F.least(F.col("wanted"), F.col("supply") * F.col("max_repeats").cast("double"))
    passes = F.when(F.col("supply") > 0, F.least(F.floor(use / F.greatest("supply", F.lit(1))), F.col("max_repeats").cast("long"))).otherwise(F.lit(0).cast("long"))
    j = j.withColumn("passes", passes)
    rest = F.when(F.col("passes") < F.col("max_repeats"), use - F.col("passes") * F.col("supply")).otherwise(F.lit(0.0))
    return j.withColumn("rest", F.greatest(rest, F.lit(0.0)))


def thresholds(s: DataFrame, b: DataFrame, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(mix, source, upto): documents with a hash below ``upto`` take part once more."""
    cur = b.where("rest > 0 and supply > 0").select("mix", "source", "rest", F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        shift = BITS - WIDTH * level
        if level:  # source and prefix, so that a source with many mixes or documents is no single key
            wanted = cur.select("source", F.col("prefix").alias("p"), F.shiftrightunsigned("prefix", shift).alias("_top")).distinct()
            inside = s.withColumn("_top", F.shiftrightunsigned("h", shift)).join(hint(wanted), ["source", "_top"])
        else:
            inside = s.withColumn("p", F.lit(0).cast("long"))
        hist = inside.groupBy("source", "p", bucket(level).alias("b")).agg(F.sum("tokens").alias("t"))
        hist = hist.withColumn("before", F.sum("t").over(W.partitionBy("source", "p").orderBy("b").rowsBetween(W.unboundedPreceding, -1))).na.fill(0, ["before"])
        # the boundary is the first bucket whose running sum passes the rest; without one the whole range is taken
        c = cur.join(hist.withColumnRenamed("p", "prefix"), ["source", "prefix"]).where(F.col("before") + F.col("t") > F.col("rest"))
        first = c.groupBy("mix", "source", "prefix", "rest").agg(F.min(F.struct("b", "before")).alias("m"))
        step = (F.col("m.b") * F.lit(1 << (BITS - WIDTH * (level + 1)))).cast("long")
        cur = materialise(first.select("mix", "source", (F.col("rest") - F.col("m.before")).alias("rest"), (F.col("prefix") + step).alias("prefix")), "thresholds")
    return cur.select("mix", "source", F.col("prefix").alias("low"), "rest")


def mixed(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, key: str = "doc_id", text: str = "text", source: str = "source", path: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The operator: (uses, shares). Uses: (mix, doc_id, source, tokens, repeats) of each document used; shares: target,
    wanted and reached tokens and shares for each source of each mix."""
    d = docs.where(F.col(key).isNotNull()).withColumn("src", plain_source(F.col(source), "unknown"))
    s = sizes(d, key, text, ["src"], path).groupBy(F.col(key).alias("doc_id")).agg(F.max(F.struct("src", "tokens")).alias("v"))
    s = materialise(s.select("doc_id", F.col("v.src").alias("source"), F.col("v.tokens").alias("tokens"), hashed(F.col("doc_id")).alias("h")), "mix-sizes")
    supply = s.groupBy("source").agg(F.sum("tokens").alias("supply"), F.count("*").alias("docs"))
    b = materialise(budgets(supply, targets, total_tokens), "budgets")
    few = b.limit(FEW_TARGETS + 1).count() <= FEW_TARGETS
    hint = F.broadcast if few else (lambda t: t)
    low = thresholds(s, b, hint)
    # the last bucket holds a 2^-36 part of a source: its rows are taken in the order of their hash while they fit
    bits = BITS - WIDTH * LEVELS
    edge = s.withColumn("_top", F.shiftrightunsigned("h", bits)).join(hint(low.withColumn("_top", F.shiftrightunsigned("low", bits))), ["source", "_top"])
    run = F.sum("tokens").over(W.partitionBy("mix", "source").orderBy("h").rangeBetween(W.unboundedPreceding, 0))
    last = edge.withColumn("run", run).where("run <= rest").groupBy("mix", "source").agg(F.max("h").alias("h_last"))
    upto = low.join(last, ["mix", "source"], "left").select("mix", "source", F.coalesce(F.col("h_last") + 1, F.col("low")).alias("upto"))
    # a rest that no bucket passes takes the whole source (rounding of the budget only)
    plan = b.join(upto, ["mix", "source"], "left").withColumn("upto", F.when(F.col("rest") > 0, F.coalesce("upto", F.lit(1 << BITS))).otherwise(F.lit(0)))
    repeats = F.col("passes") + (F.col("h") < F.col("upto")).cast("long")
    want = plan.select("mix", "source", "passes", "upto")
    if few:
        met = s.join(F.broadcast(want), "source")
    else:
        want = want.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = s.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")).join(want, ["source", "salt"])
    uses = met.withColumn("repeats", repeats).where("repeats > 0").select("mix", "doc_id", "source", "tokens", F.col("repeats").cast("int").alias("repeats"))
    got = uses.groupBy("mix", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("used_docs"), F.max("repeats").alias("most_repeats"))
    r = b.join(got, ["mix", "source"], "left").na.fill(0, ["tokens", "used_docs", "most_repeats"])
    whole = F.sum("tokens").over(W.partitionBy("mix"))
    shares = r.select(
        "mix", "source", "target_share", "max_repeats", "docs", F.col("supply").alias("supply_tokens"), F.round("wanted").cast("long").alias("wanted_tokens"), "tokens", "used_docs", "most_repeats",
        F.when(whole > 0, F.col("tokens") / whole).otherwise(F.lit(0.0)).alias("share_reached"), F.when(F.col("wanted") > 0, F.col("tokens") / F.col("wanted")).otherwise(F.lit(1.0)).alias("part_of_wanted"),
    )
    return uses, shares
