"""Connected components of a graph of long ids, by alternating stars.

Every round is two joins: each node hands its smallest neighbour to its larger
neighbours, then to its smaller ones. The number of rounds is logarithmic in
practice, rounds are written to the shared folder, and a node of huge degree
is only ever a join key (skew-splittable) or a partial minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v), given in one direction, u != v."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"))
    hung = both.join(low, both["u"] == low["w"])
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v longs); the root is the
    component's smallest id."""
    edges = saved(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "cc")
    mark = None
    while True:
        edges = saved(_star(_star(edges, True), False), "cc")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or now[0] == 0:
            break
        mark = tuple(now)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
