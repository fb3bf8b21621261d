"""Problem 4: lines repeated across the documents of one source.

Method: lines are nodes, weighted by the number of different documents of the source they stand in; consecutive repeated
lines of a document are edges, weighted likewise. Nodes and edges of high support are kept, the connected components
are the boilerplate blocks of the source, and every occurrence of a block's line is deleted.

A node is the 128-bit hash of source and normalised line, so that no text is shuffled. Support is counted after a
distinct on (node, document), both with map-side partial aggregation, which a line that stands in a third of all
documents does not unbalance; occurrences meet the kept nodes in a join salted by document.

Null or empty text has no lines of 20 letters and yields nothing. A redelivered row is the same document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, materialise, plain_source

#: White space of any kind, no-break and zero-width-free: the Unicode class plus the four separators Java leaves out.
WS = r"(?U)[\s\x1c-\x1f]+"
SALTS = 16


def normalised_line(c: Column) -> Column:
    """White space trimmed and collapsed, letters lower-cased, each run of digits taken as one ``0``."""
    t = F.regexp_replace(F.regexp_replace(c, WS, " "), "[0-9]+", "0")
    return F.lower(F.trim(t))


def lines(docs: DataFrame, key: str, text: str, source: Column, min_letters: int = 20) -> DataFrame:
    """(doc, line_no, node_a, node_b, source): one row for each line with at least ``min_letters`` letters."""
    parts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), source.alias("source"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"))
    # a line of fewer characters than letters wanted is left out before any regular expression runs
    parts = parts.where(F.length("line") >= min_letters).where(F.length(F.regexp_replace("line", r"[^\p{L}]", "")) >= min_letters)
    n = parts.select("doc", "source", (F.col("pos") + 1).alias("line_no"), normalised_line(F.col("line")).alias("norm"))
    return n.select("doc", "source", "line_no", F.xxhash64("source", "norm").alias("node_a"), F.xxhash64("norm", "source", F.lit(7)).alias("node_b"), "norm")


def repeated_nodes(occ: DataFrame, min_docs: int = 10) -> DataFrame:
    """Nodes of high support: (node_a, node_b, docs)."""
    once = occ.select("node_a", "node_b", "doc").distinct()
    return once.groupBy("node_a", "node_b").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)


def kept_occurrences(occ: DataFrame, nodes: DataFrame) -> DataFrame:
    """Occurrences whose node has high support. The node side is replicated over the salts (it is a small part of the
    lines), the line side is salted by document, so that one hot line spreads over SALTS tasks."""
    return salted_join(occ, nodes.select("node_a", "node_b"), ["node_a", "node_b"], "left_semi")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, by: str = "doc") -> DataFrame:
    """A join whose left side is salted by ``by``, the right side replicated: a key that much of the left side holds is spread
    over SALTS tasks."""
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = left.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return left.join(right, [*on, "salt"], how).drop("salt")


def edges(kept: DataFrame, min_docs: int = 10) -> DataFrame:
    """Consecutive repeated lines, both ways: (src, dst, docs) over node_a, of support ``min_docs`` or more.
    A document is one window partition: its repeated lines are few, and ordered by line."""
    w = W.partitionBy("doc").orderBy("line_no")
    pair = kept.select("doc", "line_no", "node_a").distinct().select("doc", "node_a", F.lead("node_a").over(w).alias("next"), (F.lead("line_no").over(w) - F.col("line_no")).alias("gap"))
    once = pair.where("next is not null and gap <= 2 and next <> node_a").select("doc", F.least("node_a", "next").alias("a"), F.greatest("node_a", "next").alias("b")).distinct()
    e = once.groupBy("a", "b").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    return e.select(F.col("a").alias("src"), F.col("b").alias("dst"), "docs").unionByName(e.select(F.col("b").alias("src"), F.col("a").alias("dst"), "docs"))


def components(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """Connected components (node_a, block) by least label with pointer jumping, until nothing changes: labels only fall, and
    their distances halve each round. A round is a table in the shared folder (the one before is deleted), and the driver
    sees one number of it. Lines of one large block meet its label in a salted join."""
    cur = nodes.select("node_a", F.col("node_a").alias("block")).distinct()
    if e.isEmpty():
        return cur
    e = materialise(e.select("src", "dst"), "line-edges")
    last = None
    while True:
        near = e.join(cur.select(F.col("node_a").alias("dst"), F.col("block").alias("b")), "dst").groupBy("src").agg(F.min("b").alias("b"))
        step = cur.join(near, cur.node_a == near.src, "left").select("node_a", F.col("block").alias("old"), F.least("block", F.coalesce("b", "block")).alias("block"))
        up = step.select(F.col("node_a").alias("block"), F.col("block").alias("root"))
        jumped = salted_join(step, up, ["block"], "left", "node_a").select("node_a", "old", F.least("block", F.coalesce("root", "block")).alias("block"))
        jumped = materialise(jumped, "line-labels")
        if last is not None:
            discard(last)
        last, cur = jumped, jumped.select("node_a", "block")
        if jumped.where("block <> old").isEmpty():
            return cur


def boilerplate(docs: DataFrame, key: str = "paragraph_id", text: str = "paragraph", source: Column | None = None, min_docs: int = 10, min_letters: int = 20) -> tuple[DataFrame, DataFrame]:
    """The operator: (occurrences, blocks). Occurrences: (doc, source, line_no, block) of every place of a repeated line;
    blocks: (block, source, node_a, line, docs), one row for each repeated line."""
    src = plain_source(F.col("source_type"), "knowledge") if source is None else source
    occ = lines(docs, key, text, src, min_letters)
    nodes = materialise(repeated_nodes(occ, min_docs), "line-nodes")
    kept = materialise(kept_occurrences(occ, nodes), "line-places")
    block = components(nodes, edges(kept, min_docs))
    places = salted_join(kept, block, ["node_a"], "inner").select("doc", "source", "line_no", "block").distinct()
    names = kept.groupBy("source", "node_a").agg(F.min("norm").alias("line"))
    found = names.join(nodes.select("node_a", "docs"), "node_a").join(block, "node_a").select("block", "source", "node_a", "line", "docs")
    return places, found


def named_blocks(blocks: DataFrame) -> DataFrame:
    """(source, block, line, docs): each repeated line with its block, which goes by its least line."""
    least = blocks.groupBy("source", "block").agg(F.min("line").alias("name"))
    return salted_join(blocks, least, ["source", "block"], "inner", "node_a").select("source", F.col("name").alias("block"), "line", "docs")


def clean(docs: DataFrame, places: DataFrame, key: str = "paragraph_id", text: str = "paragraph") -> DataFrame:
    """Each document (once for each key) without its repeated lines: (key, text, removed)."""
    drop = places.groupBy("doc").agg(F.collect_set("line_no").alias("drop"))  # at most the lines of one document
    one = docs.groupBy(F.col(key).alias("doc")).agg(F.max(text).alias("t"))
    j = one.join(drop, "doc", "left")
    kept = F.filter(F.split("t", "\n", -1), lambda _, i: ~F.array_contains(F.col("drop"), i + 1))
    body = F.when(F.col("drop").isNull(), F.col("t")).otherwise(F.array_join(kept, "\n"))
    return j.select(F.col("doc").alias(key), body.alias(text), F.coalesce(F.size("drop"), F.lit(0)).alias("removed"))
