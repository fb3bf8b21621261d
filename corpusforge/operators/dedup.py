"""Near-duplicate elimination by MinHash and locality-sensitive hashing, as two aggregations.

A document is kept unless an earlier one (in the order of ``seq``) shares one of its buckets; this is what a greedy pass over
the documents in order comes to, whichever of them are gone already. So a document stays if it is the first of
every bucket it is in: group the buckets, take the least ``seq`` of each, and keep those that are least in all bands.
No window, no join of candidates and no driver loop is needed, and a bucket that a third of all rows share is combined on the
map side. Signatures are built in Arrow batches without any shuffle; rows of one signature are collapsed first.

The tokens are words and signs, or those of a byte-pair vocabulary if the path of its rank file is given.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise

PRIME = 2147483647
_TOKEN = re.compile(r"\w+|[^\w\s]")


@lru_cache(maxsize=64)
def lsh_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """Bands and rows that minimise half the false-positive plus half the false-negative area around ``threshold``."""
    best = (float("inf"), 1, 1)
    x = (np.arange(2000) + 0.5) / 2000
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            p = 1 - (1 - x**r) ** b
            e = 0.5 * (p[x < threshold].sum() + (1 - p[x >= threshold]).sum())
            if e < best[0] - 1e-9:
                best = (e, b, r)
    return best[1], best[2]


@lru_cache(maxsize=8)
def permutations(n: int) -> tuple[tuple[int, int], ...]:
    """Coefficients of ``n`` universal hash functions, from a fixed rule."""
    d = lambda s: int(hashlib.sha256(s.encode()).hexdigest()[:8], 16)
    return tuple((1 + d(f"a{k}") % (PRIME - 1), d(f"b{k}") % PRIME) for k in range(n))


#: Fixed value: the public pattern that splits a text before the merges of a byte-pair vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoding(vocabulary: str):
    """The byte-pair tokenizer of a rank file, loaded once in each Python worker."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("dedup", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokens(text: str | None, vocabulary: str = "") -> set[str]:
    """Distinct tokens: lower-cased words, and signs one by one; with a vocabulary the numbers of its pieces."""
    if not text:
        return set()
    if vocabulary:
        return set(map(str, _encoding(vocabulary).encode_ordinary(text)))
    return set(_TOKEN.findall(text.lower()))


@lru_cache(maxsize=200_000)
def token_hash(token: str) -> int:
    return int(hashlib.sha256(token.encode("utf-8", "surrogatepass")).hexdigest()[:7], 16)


@lru_cache(maxsize=8)
def _coefficients(n: int) -> np.ndarray:
    return np.array(permutations(n), dtype=np.int64)


def signature(text: str | None, n: int, vocabulary: str = "") -> np.ndarray:
    """Minimum of each hash function over the tokens; a text without tokens has the prime everywhere."""
    t = tokens(text, vocabulary)
    if not t:
        return np.full(n, PRIME, dtype=np.int64)
    h = np.fromiter((token_hash(x) for x in t), dtype=np.int64, count=len(t))
    ab = _coefficients(n)
    best = np.full(n, PRIME, dtype=np.int64)
    for at in range(0, len(h), 4096):  # a very long text is taken in parts
        np.minimum(best, ((h[None, at:at + 4096] * ab[:, :1] + ab[:, 1:]) % PRIME).min(axis=1), out=best)
    return best


def band_hashes(docs: DataFrame, seq: list[str], text: str, threshold: float, num_perm: int, vocabulary: str = "") -> DataFrame:
    """(seq..., bands): the hash of each band of the signature, one array for each row."""
    b, r = lsh_bands(threshold, num_perm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(len(seq)).to_pylist():
                s = signature(t, b * r, vocabulary).reshape(b, r)
                out.append([int.from_bytes(hashlib.blake2b(row.tobytes(), digest_size=8).digest(), "little", signed=True) for row in s])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(seq))] + [pa.array(out, pa.list_(pa.int64()))], names=[*seq, "bands"])

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in seq)
    return docs.select(*seq, text).mapInArrow(run, f"{types}, bands array<long>")


def first_of_their_kind(docs: DataFrame, seq: list[str], text: str, threshold: float = 0.7, num_perm: int = 128, vocabulary: str = "") -> DataFrame:
    """The rows kept: (seq...). ``seq`` is a total order of the rows (its columns compared in turn, null first); rows that
    agree in all of it are one row."""
    n_bands, _ = lsh_bands(threshold, num_perm)
    key = F.struct(*seq)
    once = band_hashes(docs, seq, text, threshold, num_perm, vocabulary).groupBy("bands").agg(F.min(key).alias("k"))
    buckets = once.select("k", F.posexplode("bands").alias("band", "h")).groupBy("band", "h").agg(F.min("k").alias("k"))
    kept = buckets.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") == n_bands)
    return kept.select(*[F.col("k")[c].alias(c) for c in seq])


def deduplicated(docs: DataFrame, seq: list[str], text: str, threshold: float = 0.7, num_perm: int = 128, vocabulary: str = "") -> DataFrame:
    """``docs`` without its near-duplicates. Rows that agree in all of ``seq`` (nulls included) stay or go together."""
    kept = first_of_their_kind(docs, seq, text, threshold, num_perm, vocabulary)
    kept = kept.select(*[F.col(c).alias(f"_k_{c}") for c in seq])
    same = [docs[c].eqNullSafe(kept[f"_k_{c}"]) for c in seq]
    return docs.join(kept, same, "left_semi")


#: Columns of ``identified``.
ROW = ["_row1", "_row2"]


def identified(docs: DataFrame) -> DataFrame:
    """Adds 128 bits of each row's content (which column is null counts), so that rows of one place in the order are told
    apart, and identical rows are seen to be one."""
    parts = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return docs.select("*", F.xxhash64(*parts).alias(ROW[0]), F.xxhash64(F.lit(1), *parts).alias(ROW[1]))


def without_near_duplicates(docs: DataFrame, order: list[str], texts: list[str], threshold: float = 0.7, num_perm: int = 128, vocabulary: str = "") -> tuple[DataFrame, list[DataFrame]]:
    """(``docs`` after a pass for each of ``texts``, the rows kept by each pass as a table of ROW). Rows are taken in the order
    given; rows of one place are ordered by their content, and of identical rows one is left. Only ROW meets the kept
    rows, so nulls in the order lose nothing. Each pass writes its few narrow columns, so that no pass runs twice; the last
    collapse finds identical rows side by side, as the join has brought them together."""
    d = rows = identified(docs)
    passes = []
    for t in texts:
        kept = materialise(first_of_their_kind(d, [*order, *ROW], t, threshold, num_perm, vocabulary).select(*ROW), "kept")
        passes.append(kept)
        d = rows.join(kept, ROW, "left_semi")
    return d.dropDuplicates(ROW), passes
