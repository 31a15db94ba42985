"""Merkle manifest of a table, checked leaf by leaf with a recursive query.

Every row is a leaf of its group's tree; the groups' roots are the leaves of one
top tree. A tree is stored as node rows: each knows its parent and the siblings
on the way there. Digests are kept as 32 bytes and hashed as hex text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamframe.llm.common import tasks
from loamframe.session import scratch_path

# Levels between a stored node and its parent row: a block of 2**LEVELS nodes is
# hashed in one row, and a climb takes a row per LEVELS levels.
LEVELS = 8
TOP = -1  # number of the tree over the groups' roots
_LOCAL = (1 << 33) - 1  # the part of a generated row number that counts within its partition


@dataclass
class Manifest:
    """``leaves``: one node row per table row; ``nodes``: all higher node rows;
    ``roots``: the root of every group's tree; ``root``: the table's, as hex text."""

    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame
    root: str | None


def digest(*parts: Column) -> Column:
    """SHA-256 of texts put one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` written in order with a gapless ``place`` from 0.

    Range partitions are sorted on their own; only the number of rows of each
    partition is added up in one place.
    """
    spark = rows.sparkSession
    keys = [F.asc_nulls_first(c) for c in order]
    path = scratch_path(spark, "ordered")
    rows.repartitionByRange(tasks(spark), *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    ordered = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", before.alias("_before"))
    # One row per range partition, whatever the size of the table.
    return ordered.join(F.broadcast(parts), "_part").withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(_LOCAL)).drop("_at", "_part", "_before")


def _upper(level: Column) -> Column:
    """The next level: every two consecutive digests, a last single one alone."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
    return F.transform(
        runs, lambda j: F.unhex(F.sha2(F.concat(hex_text(level[2 * j]), F.coalesce(hex_text(F.get(level, 2 * j + 1)), F.lit(""))), 256))
    )


def _blocks(level: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Node rows of one stored level (tree, pos, hash, size, above) by blocks.

    ``size`` is the number of the tree's nodes on this level. Adds the parent
    (``up_tree``, ``up_level`` steps, ``up_pos``) and ``sides``: what lies left
    and right of the path at each step up. A block is at most 2**LEVELS nodes.
    """
    nodes = F.array_sort(F.collect_list(F.struct("pos", "hash", *carry)))
    # Steps to one remaining node, or LEVELS of them.
    steps = F.least(F.lit(LEVELS), F.ceil(F.log2(F.col("size").cast("double")))).cast("int")
    steps = F.when(F.col("size") > 1, F.greatest(F.lit(1), steps)).otherwise(0)
    empty = F.lit(b"")
    up = F.slice(F.array(*[F.lit(i) for i in range(1, LEVELS + 1)]), F.lit(1), F.col("steps"))
    levels = F.aggregate(up, F.array(F.transform("nodes", lambda n: n["hash"])), lambda done, _: F.concat(done, F.array(_upper(F.element_at(done, -1)))))

    def sides(j: Column) -> Column:
        def side(i: Column) -> Column:
            level, at = F.col("levels")[i - 1], F.call_function("shiftright", j, i - 1)
            right = at.bitwiseAND(1) == 1
            return F.struct(
                F.when(right, F.get(level, at - 1)).otherwise(empty).alias("left"),
                F.when(right, empty).otherwise(F.coalesce(F.get(level, at + 1), empty)).alias("right"),
            )

        return F.transform(up, side)

    return (
        level.groupBy("tree", F.shiftright("pos", LEVELS).alias("block"))
        .agg(nodes.alias("nodes"), F.first("size").alias("size"))
        .withColumn("steps", steps)
        .withColumn("levels", levels)
        .select(
            "tree", "block", "size", F.element_at(F.element_at("levels", -1), 1).alias("upper"),
            F.transform("nodes", lambda n, j: F.struct(n.alias("node"), sides(j).alias("sides"))).alias("rows"),
        )
    )


def _build(leaves: DataFrame, carry: Sequence[str], name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Trees over (tree, pos, hash, size): leaf rows, higher node rows, roots.

    Levels are built and written LEVELS at a time, so their number grows with
    the logarithm of the largest tree; a level of a tree is a table of rows,
    never one group.
    """
    spark = leaves.sparkSession
    stored, roots, level, depth = [], [], leaves, 0
    while True:
        path = scratch_path(spark, f"{name}-{depth}")
        _blocks(level, carry if depth == 0 else ()).write.parquet(path)
        blocks = spark.read.parquet(path)
        done = F.col("size") <= 1 << LEVELS
        rows = blocks.select("tree", "block", done.alias("done"), F.inline("rows"))
        stored.append(
            rows.select(
                "tree", F.lit(depth).alias("level"), "node.*", "sides",
                # The parent of a tree's last block is its leaf in the tree above.
                F.when(F.col("done"), F.lit(None).cast("int")).otherwise(depth + 1).alias("up_level"),
                F.when(F.col("done"), F.lit(None).cast("long")).otherwise(F.col("block")).alias("up_pos"),
            )
        )
        roots.append(blocks.where(done).select("tree", F.col("upper").alias("hash")))
        open_blocks = blocks.where(~done)
        if open_blocks.isEmpty():
            break
        size = F.shiftright(F.col("size") + ((1 << LEVELS) - 1), LEVELS)
        level = open_blocks.select("tree", F.col("block").alias("pos"), F.col("upper").alias("hash"), size.alias("size"))
        depth += 1

    def together(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    higher = together(stored[1:]) if stored[1:] else stored[0].drop(*carry).limit(0)
    return stored[0], higher.drop(*carry), together(roots)


def build_manifest(rows: DataFrame, group: str, order: str, leaf: Column, changed: Column) -> Manifest:
    """The manifest of ``rows``: a leaf per row, a tree per ``group``, a root.

    Leaves of a group ascend by ``order`` (null first, then by digest, then as
    read); groups ascend by value (null first, then bytewise). ``leaf`` is a
    row's digest, ``changed`` the digest to be checked instead, or null. Rows
    may repeat and a group may hold most of the table: places come from a range
    partitioning, blocks from places. An empty table has no leaves and no root.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "leaves")
    rows.select(
        F.col(group).alias("grp"), F.col(order).alias("key"), leaf.alias("hash"), changed.alias("changed"), F.monotonically_increasing_id().alias("row")
    ).write.parquet(path)
    placed = _numbered(spark.read.parquet(path), ["grp", "key", "hash", "row"])
    groups = placed.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    trees_path = scratch_path(spark, "trees")
    _numbered(groups, ["grp"]).withColumnRenamed("place", "tree").write.parquet(trees_path)
    trees = spark.read.parquet(trees_path)
    joined = placed.join(trees.withColumnRenamed("grp", "_grp"), F.col("grp").eqNullSafe(F.col("_grp")))
    leaves = joined.select("tree", (F.col("place") - F.col("first")).alias("pos"), "hash", "size", "key", "changed")
    low, middle, roots = _build(leaves, ["key", "changed"], "blocks")
    top_leaves = roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(trees.count()).alias("size"))
    top_low, top_middle, top_roots = _build(top_leaves, [], "top")
    found = top_roots.first()
    in_top = F.col("up_level").isNull()
    linked = lambda df: df.withColumns(
        {
            "up_tree": F.when(in_top, F.lit(TOP)).otherwise(F.col("tree")).cast("long"),
            "up_pos": F.when(in_top, F.col("tree")).otherwise(F.col("up_pos")),
            "up_level": F.coalesce("up_level", F.lit(0)),
        }
    )
    last = lambda df: df.withColumn("up_tree", F.when(~in_top, F.col("tree")))
    columns = ["tree", "level", "pos", "sides", "up_tree", "up_level", "up_pos"]
    nodes_path = scratch_path(spark, "nodes")
    higher = linked(middle).select(*columns).unionByName(last(top_low).select(*columns)).unionByName(last(top_middle).select(*columns))
    higher.write.parquet(nodes_path)
    return Manifest(linked(low).select(*columns, "key", "hash", "changed"), spark.read.parquet(nodes_path), roots, found["hash"].hex() if found else None)


# A path's digest from the sides of its steps, and the siblings one after the other.
_FOLD = "aggregate({sides}, {start}, (h, s) -> unhex(sha2(concat(lower(hex(s.left)), lower(hex(h)), lower(hex(s.right))), 256)))"
_PROOF = "aggregate({sides}, {start}, (p, s) -> concat(p, s.left, s.right))"
_CLIMB = f"""
WITH RECURSIVE climb (key, leaf, tree, at_tree, at_level, at_pos, folded, proof) AS (
    SELECT key, hash, tree, up_tree, up_level, up_pos, {_FOLD.format(sides='sides', start='coalesce(changed, hash)')}, {_PROOF.format(sides='sides', start="X''")}
    FROM {{leaves}}
    UNION ALL
    SELECT c.key, c.leaf, c.tree, n.up_tree, n.up_level, n.up_pos, {_FOLD.format(sides='n.sides', start='c.folded')}, {_PROOF.format(sides='n.sides', start='c.proof')}
    FROM climb AS c JOIN {{nodes}} AS n ON n.tree = c.at_tree AND n.level = c.at_level AND n.pos = c.at_pos)
SELECT key, leaf, tree, folded, proof FROM climb WHERE at_tree IS NULL
"""


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Lifts the row limit of recursive queries while one runs."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def check_leaves(manifest: Manifest, spark: SparkSession) -> DataFrame:
    """Each leaf's way to the root, climbed by a recursive query.

    (key, leaf, subroot, root, proof_sha256, folded_root, verified): the leaf and
    the roots as stored, the digest of all siblings, and the root that the
    (changed) leaf gives with them. A level of recursion appends the siblings of
    LEVELS levels to every leaf still climbing; its first step reads the leaves'
    own rows, later ones meet the higher nodes only (one for 2**LEVELS leaves).
    No leaves: no rows.
    """
    path = scratch_path(spark, "climbed")
    with _any_number_of_rows(spark):
        spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes).write.parquet(path)
    climbed = spark.read.parquet(path)
    roots = manifest.roots.select("tree", F.col("hash").alias("subroot"))
    folded = hex_text(F.col("folded"))
    return climbed.join(roots, "tree").select(
        "key", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), F.lit(manifest.root).alias("root"),
        F.sha2(hex_text(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == manifest.root).alias("verified"),
    )


def document_manifest(documents: DataFrame) -> DataFrame:
    """The manifest of a documents table with some rows tampered, checked.

    Where 7 divides the CRC-32 of the key's decimal text, n_chars is one more in
    the leaf that is checked (a null stays; a null key is never tampered). Other
    columns than doc_id, source, lang, n_chars and text are ignored.
    """
    key = F.col("doc_id")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaf = lambda n_chars: digest(*[field(c) for c in (key, F.col("source"), F.col("lang"), n_chars, F.col("text"))])
    changed = F.when((F.crc32(key.cast("string")) % 7 == 0) & F.col("n_chars").isNotNull(), leaf(more.cast("decimal(20,0)")))
    manifest = build_manifest(documents, "lang", "doc_id", leaf(F.col("n_chars")), changed)
    return check_leaves(manifest, documents.sparkSession).withColumnRenamed("key", "doc_id")
