"""Sums over all subtrees of a forest, by parallel tree contraction.

Every round rakes and compresses.  Rake takes all leaves away: a leaf's sum is
final, and what it passes up is added to its parent.  Compress takes nodes out of
unary chains: a node with one child left hands that child to its own parent, and
the edge remembers what the node would have added.  No two neighbours of a chain
go in one round: a node is taken when a bit of its rank is set and its child is
not itself such a node.  With depths as ranks the bits halve a chain each time, so
the rounds grow with the logarithm of the depth, not with the depth.

When nothing is left, the compressed nodes are put back in the reverse order of
their rounds: a node's sum is its child's plus what the log of its round holds.

Each round's tables are written to the shared folder, which cuts the lineage;
nothing but "is any row left" reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.session import through_storage


def subtree_sums(nodes: DataFrame, values: Sequence[str], rank_bits: int = 8) -> DataFrame:
    """(id, *values): each node's values added up over its subtree, the node included.

    ``nodes`` has ``id``, ``parent`` (null at a root), ``rank`` (a number; of depths up to 2**rank_bits a chain
    contracts fastest) and the values, whole numbers.  Ids are unique and every parent is a node.  Ids may be
    of any type that can be joined.  An empty table gives an empty one.
    """
    edges = [f"edge_{v}" for v in values]
    state = through_storage(nodes.select("id", "parent", "rank", *[F.col(v).cast("long").alias(v) for v in values],
                                         *[F.lit(0).cast("long").alias(e) for e in edges]), "tree")
    final: list[DataFrame] = []
    log: list[DataFrame] = []
    while True:
        children = state.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        marked = through_storage(state.join(children, "id", "left"), "tree-marked")
        leaves = marked.where("n IS NULL")
        final.append(leaves.select("id", *values))
        inner = marked.where("n IS NOT NULL")
        if inner.isEmpty():
            break
        state, spliced = compress(rake(inner, leaves, values, edges), values, edges, len(log) % rank_bits)
        log.append(spliced)
    for spliced in reversed(log):
        known = reduce(DataFrame.unionByName, final).select(
            F.col("id").alias("child"), *[F.col(v).alias(f"child_{v}") for v in values])
        final.append(through_storage(spliced.join(known, "child").select(
            "id", *[(F.col(v) + F.col(f"child_{v}")).alias(v) for v in values]), "tree-back"))
    return reduce(DataFrame.unionByName, final)


def rake(inner: DataFrame, leaves: DataFrame, values: Sequence[str], edges: Sequence[str]) -> DataFrame:
    """The nodes with children, their leaves taken away and added; ``n`` is the number of children left."""
    passed = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("raked"),
        *[F.sum(F.col(v) + F.col(e)).alias(f"raked_{v}") for v, e in zip(values, edges, strict=True)])
    added = [(F.col(v) + F.coalesce(f"raked_{v}", F.lit(0))).alias(v) for v in values]
    left = (F.col("n") - F.coalesce("raked", F.lit(0))).alias("n")
    return through_storage(inner.join(passed, "id", "left").select("id", "parent", "rank", *added, *edges, left), "tree-raked")


def compress(
    raked: DataFrame, values: Sequence[str], edges: Sequence[str], bit: int,
) -> tuple[DataFrame, DataFrame]:
    """(the nodes that stay, the log of those taken out): every taken node had one child and a parent."""
    chosen: Column = (F.col("n") == 1) & F.col("parent").isNotNull() & (F.shiftright("rank", bit) % 2 == 1)
    above = raked.where(chosen).select(
        F.col("id").alias("parent"), F.col("parent").alias("grand"), *[F.col(v).alias(f"above_{v}") for v in values],
        *[(F.col(v) + F.col(e)).alias(f"passed_{v}") for v, e in zip(values, edges, strict=True)])
    pairs = through_storage(raked.where(~chosen).join(above, "parent").select(
        F.col("parent").alias("taken"), "id", "grand",
        *[(F.col(f"above_{v}") + F.col(e)).alias(f"log_{v}") for v, e in zip(values, edges, strict=True)],
        *[(F.col(f"passed_{v}") + F.col(e)).alias(f"new_{e}") for v, e in zip(values, edges, strict=True)]), "tree-spliced")
    stay = raked.join(pairs.select(F.col("taken").alias("id")), "id", "left_anti")
    moved = pairs.select("id", "grand", *[f"new_{e}" for e in edges])
    state = through_storage(stay.join(moved, "id", "left").select(
        "id", F.coalesce("grand", "parent").alias("parent"), "rank", *values,
        *[F.coalesce(f"new_{e}", e).alias(e) for e in edges]), "tree")
    return state, pairs.select(
        F.col("taken").alias("id"), F.col("id").alias("child"), *[F.col(f"log_{v}").alias(v) for v in values])
