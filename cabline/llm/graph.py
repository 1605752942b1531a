"""Connected components of an edge table, as Spark joins and combinable minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"),
                                                           F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``edges(a, b)``.

    Alternating large and small stars: each round links a node's larger (then
    its other) neighbours to its smallest one, until the edges are stars.  A hot
    node's neighbours are never gathered: the minimum is combined before its
    shuffle and joined back.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a <> b").distinct(), "components")
    if not edges.limit(1).count():
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    for _ in range(MAX_ROUNDS):
        near = _both_ways(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (near.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        large = large.unionByName(edges.join(least.withColumnRenamed("a", "b"), "b")
                                  .where("m = b").select("a", "b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").where("b <> m").select(F.col("b").alias("a"),
                                                              F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))).distinct())
        small = cut(small.where("a <> b"), "components")
        # done when no node has two parents and no parent has a parent itself
        many = small.groupBy("a").count().where("count > 1").limit(1).count()
        deep = small.join(small.select(F.col("a").alias("b")).distinct(), "b",
                          "left_semi").limit(1).count()
        edges = small
        if not many and not deep:
            break
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def roots(parents: DataFrame) -> DataFrame:
    """(id, component) of every id in ``parents(id, component)``, where each id occurs
    once and its parent is smaller: pointer doubling, a join a round."""
    parents = cut(parents, "roots")
    for _ in range(MAX_ROUNDS):
        above = parents.select(F.col("id").alias("component"), F.col("component").alias("above"))
        step = parents.join(above, "component", "left")
        moved = cut(step.select("id", F.coalesce("above", "component").alias("component"),
                                F.col("above").isNotNull().alias("moved")), "roots")
        parents = moved.select("id", "component")
        if not moved.where("moved").limit(1).count():
            return parents
    raise RuntimeError("parents didn't settle")


def joined(part: DataFrame, of_roots: DataFrame) -> DataFrame:
    """``part(id, component)`` after its components were grouped by ``of_roots(id,
    component)``; roots that ``part`` doesn't have come in as they are."""
    top = of_roots.select(F.col("id").alias("component"), F.col("component").alias("top"))
    below = part.join(top, "component", "left").select(
        "id", F.coalesce("top", "component").alias("component"))
    return below.unionByName(of_roots.join(part.select("id"), "id", "left_anti"))
