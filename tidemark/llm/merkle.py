"""Merkle manifest of a table: a hash tree per partition value, their roots in a tree above, and proofs of single rows.

Every node carries a nested-interval label: the ranks [lo, hi) of the leaves it covers in its tree. A node of level k
covers at most ``fanout ** k`` leaves and starts at a multiple of that, so ``lo`` divided by the power of the next
level is the bucket in which its parent lies. Ancestors are attached by joins on (tree, bucket) with containment of
the intervals, and the siblings of a node are its parent's children outside its own interval.

Only digests move between tasks, never rows of the table. No group has more than ``fanout`` rows, whatever share of
the table one partition value holds; leaves are ranked by a parallel range sort and one row per range and tree.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.sources.store import settle

FANOUT = 8
RANGE_ROWS = 1_000_000      # leaves of a range, at most about
_LOCAL_BITS = 33            # monotonically_increasing_id: partition number above, row number below


class Tree(NamedTuple):
    """Trees of one forest: levels[k] has (tree, total, lo, hi, digest) and above the leaves also the children."""

    leaves: DataFrame
    levels: list[DataFrame]


class Manifest(NamedTuple):
    """The forest of all partition values, the tree over its roots, and the topmost digest (null for no rows)."""

    parts: Tree
    top: Tree
    root: str | None


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` if null, else its UTF-8 byte count, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the fields, one after the other."""
    return F.sha2(F.concat(*map(field, values)), 256)


def node_digest(digests: Column) -> Column:
    """Lowercase hex sha256 of an array of hex digests, one after the other."""
    return F.sha2(F.array_join(digests, ""), 256)


def bucket(rank: Column, width: int) -> Column:
    """Which run of ``width`` ranks a rank lies in."""
    return F.call_function("div", rank, F.lit(width).cast("long"))


def nodes_at(total: Column, level: int, fanout: int) -> Column:
    """How many nodes a tree of ``total`` leaves has at a level."""
    return bucket(total + F.lit(fanout ** level - 1), fanout ** level)


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with ``rank``, from 0 in ``order`` in each tree, and ``total``, the tree's number of rows.

    Nulls come first. Equal rows are told apart by their place in the settled input, so copies of one row spread
    over ranges. The sorted ranges are written down: a lost executor cannot number rows anew.
    """
    given = settle(rows, "merkle-rows")
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(tree).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_spread")]
    ranged = settle(given.withColumn("_spread", F.hash(F.monotonically_increasing_id()))
                    .repartitionByRange(max(least, -(-given.count() // RANGE_ROWS)), *keys)
                    .sortWithinPartitions(*keys).drop("_spread")
                    .withColumn("_id", F.monotonically_increasing_id()), "merkle-ranges")
    slot = F.shiftright("_id", _LOCAL_BITS)
    placed = ranged.withColumn("_slot", slot).withColumn("_local", F.col("_id") - F.shiftleft(slot, _LOCAL_BITS))
    runs = placed.groupBy("_slot", F.col(tree).alias("_tree")).agg(
        F.min("_local").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy("_tree")                                  # one row per range in which the tree has rows
    before = whole.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(F.col("_slot").alias("_at"), "_tree", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.sum("_n").over(whole).alias("total"))
    joined = placed.join(runs, (F.col("_slot") == F.col("_at")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return joined.withColumn("rank", F.col("_before") + F.col("_local") - F.col("_first")).drop(
        "_id", "_slot", "_local", "_at", "_tree", "_first", "_before", "_n")


def grow(leaves: DataFrame, fanout: int = FANOUT) -> Tree:
    """The levels above leaves of (tree, rank, total, digest, ...): runs of ``fanout`` nodes become one, while a tree
    has more than one. The number of levels grows with the logarithm of the largest tree.
    """
    largest = leaves.agg(F.max("total").alias("n")).first().n or 0
    levels = [leaves.select("tree", "total", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")]
    while fanout ** (len(levels) - 1) < largest:
        level = len(levels)
        runs = (levels[-1].where(nodes_at(F.col("total"), level - 1, fanout) > 1)
                .groupBy("tree", "total", bucket(F.col("lo"), fanout ** level).alias("bucket"))
                .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")))      # fanout at most
        levels.append(settle(runs.select(
            "tree", "total", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            node_digest(F.col("children.digest")).alias("digest"), "children"), f"merkle-level-{level}"))
    return Tree(leaves, levels)


def tops(tree: Tree, fanout: int = FANOUT) -> DataFrame:
    """(tree, digest): the last node of every tree; a lone leaf is its own tree's root."""
    kept = [level.where(nodes_at(F.col("total"), k, fanout) == 1).select("tree", "digest")
            for k, level in enumerate(tree.levels)]
    return reduce(DataFrame.unionAll, kept)


def with_paths(tree: Tree, above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Leaves with ``path``, what their siblings hash to: an array of (left, right) digests from the leaf up to its
    tree's root, and then as ``above`` (tree, path, ...) goes on from there, whose other columns are added.

    Level by level downwards: nodes meet the parent whose interval holds theirs in the parent's bucket; the parent's
    other children, by the difference of the intervals, are the siblings on the left and on the right.
    """
    extra = [c for c in above.columns if c not in ("tree", "path")]
    roots = above.withColumnRenamed("tree", "_tree")
    parents = None
    for k in range(len(tree.levels) - 1, -1, -1):
        if k:
            nodes = tree.levels[k]
        else:
            nodes = tree.leaves.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1)
        single = nodes_at(F.col("total"), k, fanout) == 1
        found = nodes.where(single).join(roots, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        if parents is not None:
            sides = F.struct(
                F.array_join(F.filter("_children", lambda c: c["hi"] <= F.col("lo"))["digest"], "").alias("left"),
                F.array_join(F.filter("_children", lambda c: c["lo"] >= F.col("hi"))["digest"], "").alias("right"))
            below = (nodes.where(~single).withColumn("_at", bucket(F.col("lo"), fanout ** (k + 1)))
                     .join(parents, (F.col("_at") == F.col("_bucket")) & F.col("tree").eqNullSafe(F.col("_tree"))
                           & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
                     .withColumn("path", F.concat(F.array(sides), "_path")))
            found = found.unionByName(below.select(*nodes.columns, "path", *extra))
        if not k:
            return found.drop("lo", "hi")
        found = settle(found, f"merkle-paths-{k}")
        parents = found.select(
            F.col("tree").alias("_tree"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("children").alias("_children"),
            bucket(F.col("lo"), fanout ** k).alias("_bucket"), F.col("path").alias("_path"), *extra)
    raise AssertionError("a tree has at least one level")


def build(rows: DataFrame, tree: str, order: list[str], fanout: int = FANOUT) -> Manifest:
    """The manifest of rows with ``digest``: leaves of equal ``tree`` ascend by ``order``, then by digest, nulls first;
    the roots of all trees ascend by the tree's value, null first, under one tree. Other columns stay on the leaves.

    Rows of equal order and digest are interchangeable; equal ids of unlike rows are ordered by digest; an empty table
    has no nodes and a null root. ``rows`` must not have columns named tree, rank, total or beginning with ``_``.
    """
    parts = grow(settle(ranked(rows.withColumnRenamed(tree, "tree"), "tree", [*order, "digest"]), "merkle-leaves"), fanout)
    roots = tops(parts, fanout).select(F.lit(0).alias("tree"), F.col("tree").alias("part"), "digest")
    top = grow(settle(ranked(roots, "tree", ["part"]), "merkle-tops"), fanout)
    last = tops(top, fanout).first()
    return Manifest(parts, top, last.digest if last else None)


def proofs(manifest: Manifest, fanout: int = FANOUT) -> DataFrame:
    """The leaves with ``path`` (their siblings, level by level up to the root) and ``subroot``."""
    start = manifest.top.leaves.sparkSession.createDataFrame([(0, [])], "tree int, path array<struct<left string, right string>>")
    roots = with_paths(manifest.top, start, fanout).select(
        F.col("part").alias("tree"), "path", F.col("digest").alias("subroot"))
    return with_paths(manifest.parts, roots, fanout)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda digest, side: F.sha2(F.concat(side["left"], digest, side["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Lowercase hex sha256 of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda side: F.concat(side["left"], side["right"])), ""), 256)


def nodes(manifest: Manifest) -> DataFrame:
    """(tree, above, level, lo, hi, digest): every node with its label; ``above`` marks the tree over the roots."""
    out = []
    for forest, above in ((manifest.parts, False), (manifest.top, True)):
        for k, level in enumerate(forest.levels):
            name = F.lit(None).cast("string") if above else F.col("tree").cast("string")
            out.append(level.select(name.alias("tree"), F.lit(above).alias("above"), F.lit(k).alias("level"), "lo", "hi", "digest"))
    return reduce(DataFrame.unionAll, out)
