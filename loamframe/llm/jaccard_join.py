"""Jaccard join of texts on word shingles by MinHash bands.

Every text has a signature per tree, cut to the longest prefix with which texts
at the threshold meet in some tree with the wanted probability. That depth
follows from the threshold alone, so a prefix is a band, and no trie is built;
the texts of a band are verified exactly on their shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.common import shuffles_removed, slices, whole_text
from loamframe.llm.shingles import MinHash, WordHashes, normal_words, shingle_hashes
from loamframe.session import scratch_path

TREES = 24
DEPTH = 8
RECALL = 0.9999
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 300_000


def prefix_depth(similarity: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix under which two texts of that similarity share a node
    of some tree with probability ``recall``, going down from ``depth``."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def _signed(documents: DataFrame, doc: str, text: str, trees: int, prefix: int) -> DataFrame:
    """Each row with the digest of its words, its number of shingles and the
    trie node it is below in every tree (none for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, minima = WordHashes(), MinHash(trees * prefix)
        for b in slices(batches, 1):
            words = [normal_words(t.as_py()) for t in b.column(1)]
            sets = [shingle_hashes(w, hashes) for w in words]
            digests = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]
            values = minima.signatures(sets).astype(np.uint64).reshape(len(sets), trees, prefix)
            nodes = np.zeros((len(sets), trees), np.uint64)
            for i in range(prefix):
                nodes = (nodes ^ values[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
                nodes ^= nodes >> np.uint64(32)
            nodes = nodes.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(digests), pa.array([len(s) for s in sets], pa.int64()), pa.array([list(n) if len(s) else None for n, s in zip(nodes, sets)], pa.list_(pa.int64()))],
                names=["_doc", "_text", "_digest", "_size", "_nodes"],
            )

    texts = documents.select(F.col(doc).cast("long"), whole_text(text))
    return texts.mapInArrow(run, "_doc long, _text string, _digest binary, _size long, _nodes array<long>")


def _links(similarity: float):
    """Links among the texts of one pair of blocks below one trie node; of two
    different blocks only those between them, as each also meets itself."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, low, high = int(key[0]), int(key[2]), int(key[3])
        side = group["side"].to_numpy()
        hashes = WordHashes()
        sets = [np.unique(shingle_hashes(normal_words(t), hashes)) for t in group["text"]]
        sizes = np.array([len(s) for s in sets])
        m = len(sets)
        shingles, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        who = np.repeat(np.arange(m), sizes)
        shared = times[code] > 1
        code, who = code[shared], who[shared]
        order = np.argsort(code, kind="stable")
        code, who = code[order], who[order]
        common = np.zeros((m, m), np.float32)
        # Columns of the incidence matrix, a few thousand shingles at a time.
        step = max(1, 4_000_000 // m)
        number = np.cumsum(np.append(0, np.diff(code) > 0)) if len(code) else code
        for start in range(0, int(number[-1]) + 1 if len(number) else 0, step):
            a, b = np.searchsorted(number, [start, start + step])
            part = np.zeros((m, int(number[b - 1]) - start + 1), np.float32)
            part[who[a:b], number[a:b] - start] = 1
            common += part @ part.T
        union = sizes[:, None] + sizes[None, :] - common
        # 5 * common >= 4 * union in whole numbers for 0.8, without rounding a quotient
        linked = np.triu(common >= similarity * union - 1e-6, 1)
        if low != high:
            linked &= side[:, None] != side[None, :]
        i, j = np.nonzero(linked)
        if len(i):
            # A pair that meets in several trees counts in the first only.
            nodes = np.stack(group["nodes"].to_numpy())
            first = np.array([int(np.argmax(nodes[x] == nodes[y])) for x, y in zip(i, j)]) if len(i) < 4096 else np.concatenate([(nodes[i[k : k + 4096]] == nodes[j[k : k + 4096]]).argmax(1) for k in range(0, len(i), 4096)])
            i, j = i[first == tree], j[first == tree]
        copies = group["copies"].to_numpy()
        n = np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
        # A spanning forest stands for all links found here.
        root = np.arange(m)
        while len(i):
            low = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            root = root[root]
            if (root == before).all():
                break
        rows = np.flatnonzero(n)
        ids = group["rep"].to_numpy()
        return pd.DataFrame({"rep": ids[rows], "other": ids[root[rows]], "n": n[rows].astype(np.int64)})

    return run


def _components(spark, edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's connected component."""

    def kept(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "labels")
        df.write.parquet(path)
        return spark.read.parquet(path)

    both = kept(edges.where("a != b").unionByName(edges.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        low = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("_l").alias("_low"))
        met = labels.join(low, "node").select("node", "label", F.least("label", "_low").alias("_new"))
        # Then each label moves on to its own label, so long chains halve.
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_far"))
        moved = kept(met.join(jump, "_new", "left").select("node", F.col("label").alias("_old"), F.least(F.col("_new"), F.coalesce("_far", "_new")).alias("label")))
        if moved.where("label != _old").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def similar_classes(documents: DataFrame, similarity: float = 0.8, doc: str = "doc_id", text: str = "text", trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """One row per row of ``documents``: its key, ``class_id`` (the least key
    among all texts it is linked to, directly or through others) and
    ``n_links`` (rows it is linked to itself, equal texts included).

    Two texts are linked if the Jaccard similarity of their sets of five-word
    shingles (of lower-cased words; one shingle if there are fewer) reaches
    ``similarity``. Texts with equal words, also those without any, are copies:
    they are one text in all that follows. A null text is empty; null keys are
    never a class's key unless it has no other; rows may repeat; other columns
    are ignored; an empty table gives no rows.

    Copies are counted before anything is shuffled. A trie node with the same
    texts as another tree's is looked at once. The texts of a node are cut into
    blocks of bounded size and each pair of blocks is one task's group, which
    returns counts and a spanning forest, never all pairs.
    """
    rows, per_text = _joined(documents, similarity, doc, text, trees, depth, recall)
    return rows.select("_doc", "_digest").join(per_text, "_digest").select(F.col("_doc").alias(doc), "class_id", "n_links")


def first_of_classes(documents: DataFrame, similarity: float = 0.8, doc: str = "doc_id", text: str = "text", trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """(key, text_hash) of one row of every class of ``similar_classes``: the
    least key, null ones last, then the least ``xxhash64`` of the text."""
    rows, per_text = _joined(documents, similarity, doc, text, trees, depth, recall)
    marked = rows.select("_doc", "_digest", F.xxhash64("_text").alias("_hash")).join(per_text, "_digest")
    first = F.min(F.struct(F.col("_doc").isNull(), "_doc", "_hash")).alias("first")
    return marked.groupBy("label").agg(first).select(F.col("first._doc").alias("key"), F.col("first._hash").alias("text_hash"))


def _joined(documents: DataFrame, similarity: float, doc: str, text: str, trees: int, depth: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """All rows with their digest, and what ``linked_texts`` gives for them."""
    spark = documents.sparkSession
    prefix = prefix_depth(similarity, trees, depth, recall)
    path = scratch_path(spark, "signed")
    signed = _signed(documents, doc, text, trees, prefix)
    signed.withColumn("_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    texts = rows.select(F.col("_row").alias("rep"), F.col("_text").alias("text"))
    return rows, linked_texts(rows, lambda members: texts, similarity)


def linked_texts(rows: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """(_digest, label, class_id, n_links) of every digest in ``rows`` (_row, _doc,
    _digest, _size, _nodes), links as in ``similar_classes`` between texts that
    share a node; ``label`` is the same throughout a class.

    ``texts`` gives (rep, text) for at least the rows named as ``rep`` in what
    it is called with.
    """
    spark = rows.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        with shuffles_removed(spark):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    classes = kept(
        rows.groupBy("_digest").agg(
            F.min("_row").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("_doc").alias("first_doc"),
            F.min("_size").alias("size"), F.any_value("_nodes").alias("nodes"),
        ),
        "texts",
    )
    below = classes.where(F.col("nodes").isNotNull()).select("rep", "size", F.posexplode("nodes").alias("tree", "node"))
    nodes = kept(
        below.groupBy("tree", "node")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), F.sum(F.shiftright(F.xxhash64("rep"), 24)).alias("who"))
        .where("n > 1")
        .groupBy("n", "who", "shingles")
        .agg(F.min(F.struct("tree", "node")).alias("at"))
        .select("at.tree", "at.node", F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")),
        "nodes",
    )
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = kept(below.join(nodes, ["tree", "node"]).select("tree", "node", "blocks", mine.alias("side"), "rep"), "members")
    known = classes.select("rep", "copies", "nodes")
    # Texts are joined once per node they are in, and only then dealt to the pairs of its blocks.
    dealt = (
        members.join(known, "rep").join(texts(members), "rep")
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("side", "_with"), "high": F.greatest("side", "_with")})
        .drop("blocks", "_with")
    )
    found = kept(dealt.groupBy("tree", "node", "low", "high").applyInPandas(_links(similarity), "rep long, other long, n long"), "links")
    labels = _components(spark, found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("n").alias("n"))
    grouped = classes.select("rep", "copies", "first_doc", "_digest").join(linked, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    firsts = grouped.groupBy("label").agg(F.min("first_doc").alias("class_id"))
    return grouped.join(firsts, "label").select("_digest", "label", "class_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
