"""Problem 7: filling fixed-capacity containers with items.

Method: variable-capacity best-fit. Several permitted lengths are optimised jointly: an item goes into the open bin it
fills best; if none holds it, the bin size of least cost is opened (each opening policy is tried, the cheapest result is
kept), and at the end each bin is downsized to the least permitted length that holds its contents. A profile with one
capacity is the same with one permitted length.

Items are spread by the hash of their key over shards of a bounded number of items; a shard is packed in one task in
descending size, and leaves few bins unfilled however large the corpus is. Only keys and sizes are shuffled, never text.
An item is divided only if it exceeds the capacity: into full bins and one rest, which is packed like any other item.
Items of size 0 (null or empty texts) go into any bin. Rows without key are left out; a repeated key counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .tokens import VOCABULARY, sizes

SHARD_ITEMS = 8192
#: Profiles that one pass over the sizes fills; more take further passes.
PROFILES = 1000
#: Cost of a bin besides its length, in tokens: what a sequence costs however short it is.
OVERHEAD = 8
#: Length at which a sequence costs twice its tokens, as the work of attention grows with the square of the length.
ATTENTION = 4096


def bin_cost(length: int, attention: int = 0) -> float:
    """Cost of a bin in tokens: its length, what any bin costs, and with ``attention`` the work that grows with the square."""
    return length + OVERHEAD + (length * length / attention if attention else 0.0)



def best_fit(items: list[int], lengths: list[int], policy: str, attention: int = 0) -> tuple[list[int], list[int]]:
    """Best fit of items in the order given. Returns the bin of each item, and the length each bin was opened with.
    Open bins are kept by free space, the free spaces that occur in one integer's bits, so the tightest bin that
    holds an item is found by a shift."""
    lengths = sorted(lengths)
    top = lengths[-1]
    free: dict[int, list[int]] = {}
    mask = 0
    bins: list[int] = []
    where: list[int] = []
    for s in items:
        m = mask >> s
        if m:
            r = s + (m & -m).bit_length() - 1
            stack = free[r]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << r)
        else:
            fits = [c for c in lengths if c >= s]
            if policy == "least":
                c = fits[0]
            elif policy == "largest":
                c = top
            else:  # least cost for each token the bin can be expected to hold: as many items of this size as go in, and small ones
                c = min(fits, key=lambda c: (bin_cost(c, attention) / max(c // max(s, 1) * max(s, 1), 0.9 * c), c))
            b, r = len(bins), c
            bins.append(c)
        where.append(b)
        r -= s
        free.setdefault(r, []).append(b)
        mask |= 1 << r
    return where, bins


def pack(items: list[int], lengths: list[int], attention: int = 0) -> tuple[list[int], list[int], list[int]]:
    """Cheapest result of the opening policies after downsizing: bin of each item, final length and contents of each bin."""
    best = None
    asc = sorted(lengths)
    for policy in ("cost", "least", "largest") if len(lengths) > 1 else ("least",):
        where, bins = best_fit(items, lengths, policy, attention)
        held = [0] * len(bins)
        for s, b in zip(items, where):
            held[b] += s
        final = [next(c for c in asc if c >= h) for h in held]
        cost = sum(bin_cost(c, attention) for c in final)
        if best is None or cost < best[0]:
            best = (cost, where, final, held)
    return best[1], best[2], best[3]


OUT = "profile string, container long, capacity int, doc_id {key}, piece int, first_token long, tokens int, filled int"


def pack_shard(profiles: list[tuple[str, list[int]]], attention: int = 0):
    """Packer of one shard for every profile (name, permitted lengths)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf.sort_values(["tokens", "doc_id"], ascending=[False, True])
        ids, toks, shard = d.doc_id.tolist(), d.tokens.tolist(), int(d.shard.iloc[0])
        out: list[tuple] = []
        for name, lengths in profiles:
            cap = max(lengths)
            items: list[tuple] = []  # size, place of the key, piece, first token
            n_full = 0
            for i, t in enumerate(toks):
                k = 0
                while t - k * cap > cap:
                    out.append((name, (shard << 32) + (1 << 31) + n_full, cap, ids[i], k, k * cap, cap, cap))
                    n_full += 1
                    k += 1
                items.append((t - k * cap, i, k, k * cap))
            items.sort(key=lambda x: (-x[0], x[1]))
            where, final, held = pack([x[0] for x in items], lengths, attention)
            out += [(name, (shard << 32) + b, final[b], ids[i], k, at, s, held[b]) for (s, i, k, at), b in zip(items, where)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return run


def containers(docs: DataFrame, profiles: list[tuple[str, list[int]]], key: str = "doc_id", text: str = "text", path: str = VOCABULARY, shard_items: int = SHARD_ITEMS, attention: int = 0) -> DataFrame:
    """The operator: one row for each piece placed (OUT), its key of the table's own type. ``container`` is unique within a
    profile, ``filled`` its contents; ``attention`` is a parameter of the cost of a bin."""
    s = sizes(docs.where(F.col(key).isNotNull()), key, text, [], path).groupBy(F.col(key).alias("doc_id")).agg(F.max("tokens").alias("tokens"))
    s = materialise(s, "sizes")
    n = max(1, -(-s.count() // shard_items))
    kind = docs.schema[key].dataType.simpleString()
    # a partition for each shard, up to what a job can have: hashing would put some together, adaptive execution all of them
    d = s.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")).repartitionById(min(n, 100_000), F.col("shard"))
    out = [_placed(d, profiles[at:at + PROFILES], attention, OUT.format(key=kind)) for at in range(0, max(1, len(profiles)), PROFILES)]
    return reduce(DataFrame.unionAll, out)


def _placed(shards: DataFrame, profiles: list[tuple[str, list[int]]], attention: int, schema: str) -> DataFrame:
    packer = pack_shard(profiles, attention)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            for _, g in pd.concat(parts).groupby("shard"):
                yield packer(g)

    return shards.mapInPandas(run, schema)


def read_profiles(table: DataFrame, limit: int = 1_000_000) -> list[tuple[str, int]]:
    """The profiles as a list; more than ``limit`` raises an error, null names or capacities below 1 are left out."""
    rows = table.where("profile is not null and capacity >= 1").select("profile", "capacity").distinct().orderBy("capacity", "profile").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} packing profiles")
    return [(r.profile, int(r.capacity)) for r in rows]


def usage(placed: DataFrame) -> DataFrame:
    """Room used by profile and capacity: (profile, capacity, containers, pieces, tokens, room, fill)."""
    one = placed.groupBy("profile", "container", "capacity").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"))
    g = one.groupBy("profile", "capacity").agg(F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"))
    room = F.col("containers") * F.col("capacity")
    return g.withColumn("room", room).withColumn("fill", F.round(F.col("tokens") / room, 6))
