"""Whether a passage was taken word for word from its text."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import once, squeezed


def contained(source: Column, extract: Column) -> Column:
    """The fast path: the extract is in the source, white space squeezed. Null reads as ""."""
    return squeezed(F.coalesce(source, F.lit(""))).contains(squeezed(F.coalesce(extract, F.lit(""))))


def matching_share(source: str, extract: str) -> float:
    """Characters of the extract in matching blocks with the source; blocks as difflib finds them, popular characters left out."""
    if not extract:
        return 1.0
    m = SequenceMatcher(None, source, extract)
    return sum(b.size for b in m.get_matching_blocks()) / len(extract)


def _shares(source: pd.Series, extract: pd.Series) -> pd.Series:
    return pd.Series([1.0 if a is None else matching_share(a, b) for a, b in zip(source, extract)], dtype="float64")


def verbatim(df: DataFrame, source: str, extract: str, threshold: float = 0.9) -> DataFrame:
    """Adds ``verbatim``. A UDF behind a condition sees every row all the same, so rows that pass the fast path give it nulls:
    they are read once like the others, but no text of theirs goes to Python and nothing is compared."""
    d = once(df, _a=squeezed(F.coalesce(source, F.lit(""))), _b=squeezed(F.coalesce(extract, F.lit(""))))
    d = once(d, _in=F.col("_a").contains(F.col("_b")))
    slow = lambda c: F.when(~F.col("_in"), F.col(c))
    share = F.pandas_udf(_shares, "double")(slow("_a"), slow("_b"))
    return d.withColumn("verbatim", F.col("_in") | (share >= threshold)).drop("_a", "_b", "_in")
