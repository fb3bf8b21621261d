"""Problem 5: text values cut off, by a field limit or elsewhere, and how often each source truncates.

Method: lengths (characters and bytes of the value, and of the text it was taken from if that is given) are counted per source; a
length far more frequent than its neighbours is a candidate limit. Per source a right-censored log-normal distribution is fitted
by maximum likelihood (EM over sufficient statistics, so a source is one small row group however many values it has),
the values above expectation at a limit being the censored ones. A value at a limit gets the posterior of being
censored, any other the base rate; its log-odds are added to the evidence of the ending (endings.py). So an ending without a
stop that may as well be an entry, a name or a heading is a cut at a limit and whole elsewhere, while a finished
sentence is whole even there, and a word that breaks off is cut anywhere.

Null and blank values are not cut. Redelivered rows count once.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_rows, materialise, plain_source
from .endings import ending_evidence

BASE_RATE = 0.05


def _measure(text: str | None, original: str | None) -> tuple:
    t = text or ""
    o = original or ""
    tail = t.rstrip()
    return (len(t), len(t.encode("utf-8", "surrogatepass")), len(o), bool(o) and bool(tail) and o.rstrip().endswith(tail), float(ending_evidence(text, original)))


def measures(docs: DataFrame, key: str, text: str, original: str | None, source: Column) -> DataFrame:
    """(key, source, chars, bytes, original_chars, to_end, evidence), one row for each key."""
    cols = docs.select(key, F.col(text).alias("t"), (F.col(original) if original else F.lit(None).cast("string")).alias("o"), source.alias("source")).where(F.col(key).isNotNull())
    m = map_rows(cols, [key, "source"], ["t", "o"], _measure, "chars int, bytes int, original_chars int, to_end boolean, evidence double")
    return m.dropDuplicates([key])


def length_counts(m: DataFrame) -> DataFrame:
    """(source, unit, length, n): at most one row for each length that occurs."""
    units = F.array(
        F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")),
        F.struct(F.lit("original").alias("unit"), F.col("original_chars").alias("length")),
    )
    u = m.select("source", F.explode(units).alias("u")).select("source", "u.unit", "u.length").where("length > 0")
    return u.groupBy("source", "unit", "length").agg(F.count("*").alias("n"))


def candidate_limits(counts: DataFrame, reach: int = 20, least: int = 8, sigmas: float = 8.0) -> DataFrame:
    """Lengths whose count exceeds the mean of the lengths within ``reach`` by ``sigmas`` (Poisson) and is ``least`` or more."""
    w = W.partitionBy("source", "unit").orderBy("length").rangeBetween(-reach, reach)
    c = counts.select("*", ((F.sum("n").over(w) - F.col("n")) / F.lit(2.0 * reach)).alias("near"))
    return c.where((F.col("n") >= least) & (F.col("n") - F.col("near") > sigmas * F.sqrt(F.col("near") + 0.5)))


FIT = "source string, unit string, length int, n long, mu double, sigma double, total long, expected double, posterior double"


def _survival_moments(a: float) -> tuple[float, float]:
    """Mean and second moment of a standard normal above ``a``."""
    tail = 0.5 * math.erfc(a / math.sqrt(2))
    h = math.exp(-0.5 * a * a) / math.sqrt(2 * math.pi) / tail if tail > 1e-12 else a + 1 / max(a, 1e-6)
    return h, 1 + a * h


def fit_censored(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of one source and unit: the first sums (n, sx, sxx) of the log-lengths off the limits, and one row a limit.
    EM for mu and sigma of the log-normal with ``n - near`` values right-censored at each limit."""
    base = pdf[pdf.length.isna()]
    lim = pdf[pdf.length.notna()].sort_values("length")
    n0, sx, sxx = (float(base[c].sum()) for c in ("n", "sx", "sxx"))
    L = [math.log(x) for x in lim.length]
    cens = [max(0.0, a - b) for a, b in zip(lim.n, lim.near)]
    if n0 < 2:
        return pd.DataFrame(columns=[c.split()[0] for c in FIT.split(", ")])
    mu, sd = sx / n0, max(math.sqrt(max(sxx / n0 - (sx / n0) ** 2, 0.0)), 0.05)
    for _ in range(200):
        n, s1, s2 = n0, sx, sxx
        for l, k in zip(L, cens):
            h, h2 = _survival_moments((l - mu) / sd)
            n, s1, s2 = n + k, s1 + k * (mu + sd * h), s2 + k * (mu * mu + 2 * mu * sd * h + sd * sd * h2)
        new, nsd = s1 / n, max(math.sqrt(max(s2 / n - (s1 / n) ** 2, 0.0)), 0.05)
        done = abs(new - mu) + abs(nsd - sd) < 1e-7
        mu, sd = new, nsd
        if done:
            break
    total = n0 + float(lim.n.sum())
    out = []
    for x, l, k, c in zip(lim.length, L, lim.n, cens):
        dens = math.exp(-0.5 * ((l - mu) / sd) ** 2) / (sd * math.sqrt(2 * math.pi) * float(x))
        expected = min(float(k), max(total * dens, float(k) - c))
        out.append((pdf.source.iloc[0], pdf.unit.iloc[0], int(x), int(k), mu, sd, int(total), expected, min(0.98, max(0.0, (float(k) - expected) / float(k)))))
    return pd.DataFrame(out, columns=[c.split()[0] for c in FIT.split(", ")])


def limits(m: DataFrame) -> DataFrame:
    """Censoring posterior of each candidate limit (FIT), one row for each source, unit and limit."""
    counts = materialise(length_counts(m), "lengths")
    cand = candidate_limits(counts).select("source", "unit", "length", "n", "near")
    x = F.log(F.col("length").cast("double"))
    off = counts.join(cand.select("source", "unit", "length"), ["source", "unit", "length"], "left_anti")
    sums = off.groupBy("source", "unit").agg(F.sum("n").alias("n"), F.sum(x * F.col("n")).alias("sx"), F.sum(x * x * F.col("n")).alias("sxx"))
    none = F.lit(None)
    rows = sums.select("source", "unit", none.cast("int").alias("length"), "n", none.cast("double").alias("near"), "sx", "sxx").unionByName(
        cand.select("source", "unit", "length", "n", "near", none.cast("double").alias("sx"), none.cast("double").alias("sxx"))
    )
    return rows.groupBy("source", "unit").applyInPandas(fit_censored, FIT)


def truncated(docs: DataFrame, key: str = "selected_id", text: str = "paragraph", original: str | None = None, source: Column | None = None) -> DataFrame:
    """The operator: (key, source, chars, evidence, posterior, log_odds, cut), one row for each key. The values alone are read;
    ``original`` may name a column with the texts they were taken from, whose limits and continuations count then too."""
    src = plain_source(F.col("source_type"), "knowledge") if source is None else source
    m = materialise(measures(docs, key, text, original, src), "endings")
    lim = materialise(limits(m), "limits").select("source", "unit", "length", "posterior")
    at = lambda unit, name: lim.where(F.col("unit") == unit).select("source", F.col("length").alias(name), F.col("posterior").alias(f"p_{name}"))
    # the limits are few by their definition (peaks of a length histogram); Spark's own size check decides on broadcast
    j = m.join(at("chars", "chars"), ["source", "chars"], "left").join(at("bytes", "bytes"), ["source", "bytes"], "left").join(at("original", "original_chars"), ["source", "original_chars"], "left")
    p = F.greatest(F.coalesce("p_chars", F.lit(0.0)), F.coalesce("p_bytes", F.lit(0.0)), F.when(F.col("to_end"), F.coalesce("p_original_chars", F.lit(0.0))).otherwise(F.lit(0.0)), F.lit(BASE_RATE))
    r = j.select(key, "source", "chars", "evidence", p.alias("posterior"))
    odds = F.col("evidence") + F.log(F.col("posterior") / (1 - F.col("posterior")))
    return r.withColumn("log_odds", odds).withColumn("cut", F.col("log_odds") > 0)
