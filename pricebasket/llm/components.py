"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.session import stage


def components(links: DataFrame) -> DataFrame:
    """(x, y) links between 64-bit nodes to (node, root), a row per linked node.

    In each round every node takes the neighbour, or itself, of the least hash under that round's
    seed as its parent, goes on to the parent's parent twice, and links are rewritten between parents; a
    constant share of the nodes that still have links goes away each round, whatever the shape of the
    graph. Rounds are written to the shared folder; nothing but the emptiness of the rest reaches the driver.
    """
    rest = stage(links.select("x", "y").filter("x <> y"), "links")
    roots = stage(rest.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    turn = 0
    while not rest.isEmpty():
        turn += 1
        both = rest.unionByName(rest.select(F.col("y").alias("x"), F.col("x").alias("y")))
        near = both.groupBy("x").agg(F.min(F.struct(F.xxhash64("y", F.lit(turn)).alias("h"), "y")).alias("least"))
        own = F.xxhash64("x", F.lit(turn))
        parents = near.select(
            F.col("x").alias("root"), F.when(F.col("least.h") < own, F.col("least.y")).otherwise(F.col("x")).alias("parent"))
        for _ in range(2):
            above = parents.select(F.col("root").alias("parent"), F.col("parent").alias("above"))
            parents = parents.join(above, "parent").select("root", F.col("above").alias("parent"))
        parents = stage(parents, "parents")
        roots = stage(roots.join(parents, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots")
        of_x = parents.select(F.col("root").alias("x"), F.col("parent").alias("px"))
        of_y = parents.select(F.col("root").alias("y"), F.col("parent").alias("py"))
        rest = stage(
            rest.join(of_x, "x").join(of_y, "y").filter("px <> py")
            .select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y")).distinct(), "links")
    return roots


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots after more ``links``, which are looked at between the roots that they connect."""
    def named(side: str) -> DataFrame:
        return roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))

    between = links.join(named("x"), "x", "left").join(named("y"), "y", "left").select(
        F.coalesce("rx", "x").alias("x"), F.coalesce("ry", "y").alias("y")).distinct()
    more = components(between)
    moved = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
    return stage(moved.select("node", F.coalesce("new", "root").alias("root")).unionByName(
        more.join(roots, "node", "left_anti").select("node", "root")), "roots")
