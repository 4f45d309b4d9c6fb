"""Connected components of a table of links, by contraction.

Each round every node takes its smallest neighbour (or itself) as parent, the
parents are followed once more, and the links are rewritten to the parents.  A
chain shrinks by a constant factor in each round, so the number of rounds grows
with the logarithm of its length.  Every round's tables are written to the shared
folder, which cuts the lineage; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.session import through_storage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b): the smallest node of its component.

    Repeated links, loops and links with a null end are fine and add nothing.
    """
    links = links.where("a <> b")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = through_storage(both, "links")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    while not edges.isEmpty():
        first = edges.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("parent"))
        above = first.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        parents = through_storage(first.join(above, "parent").select("node", F.col("grand").alias("parent")), "parents")
        roots = through_storage(
            roots.join(parents.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("parent", "root").alias("root")), "roots")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = through_storage(
            edges.join(left, "a").join(right, "b").where("pa <> pb").select(
                F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "links")
    return roots
