"""Connected components by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(node, root)`` for every node of an edge, root the smallest node of its component.

    ``edges`` has long columns ``a`` and ``b``. Each round hooks every node to its
    smallest neighbour if that is smaller, flattens the resulting trees by doubling
    and contracts the edges, so the graph shrinks by a factor each time. Rounds
    end when no edge joins two roots. Nothing but counts reaches the driver.
    """
    level = scratch.save(edges.where("a <> b").select("a", "b").distinct(), f"{name}-e0")
    trees: list[DataFrame] = []
    k = 0
    while not level.isEmpty():
        both = level.union(level.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = scratch.save(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), f"{name}-p{k}-0"
        )
        jumps = 0
        while True:
            over = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumps += 1
            up = scratch.save(up.join(over, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), f"{name}-p{k}-{jumps}")
            still = not up.where("moved").isEmpty()
            up = up.select("node", "root")
            scratch.drop(f"{name}-p{k}-{jumps - 1}")
            if not still:
                break
        trees.append(up)
        level = scratch.save(
            level.join(up.toDF("a", "ra"), "a")
            .join(up.toDF("b", "rb"), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            f"{name}-e{k + 1}",
        )
        scratch.drop(f"{name}-e{k}")
        k += 1
    if not trees:
        return level.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = trees[0]
    for j, tree in enumerate(trees[1:]):
        out = scratch.save(
            out.join(tree.toDF("root", "higher"), "root", "left").select("node", F.coalesce("higher", "root").alias("root")), f"{name}-r{j}"
        )
    return out
