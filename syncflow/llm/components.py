"""Connected components of a graph given by its edges.

Large-star and small-star steps (Kiveris et al., 2014) alternate until every node
points at the smallest node of its component. Each step is a grouping and a join
over edges; nothing is gathered per component. Steps are written to the staging
folder, so each reads whole tables and a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncflow.staging import Staging


def _checked(edges: DataFrame) -> tuple[int, int]:
    seen = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return seen[0], seen[1]


def _star(edges: DataFrame, staging: Staging, large: bool) -> DataFrame:
    """One step; edges are (a, b) with a < b, and so is the result."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    near = down.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))) if large else down
    least = staging.write(near.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = near.join(least, "u")
    if large:
        # Every larger neighbour moves to the smallest node around.
        smallest = F.least("u", "m")
        moved = linked.where(F.col("v") > F.col("u")).select(
            smallest.alias("a"), F.col("v").alias("b")
        )
    else:
        # So do the smaller neighbours, and the node itself.
        moved = linked.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    return staging.write(moved.where(F.col("a") < F.col("b")).distinct(), "edges")


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b); root is the smallest node reachable.

    Loops are ignored. An empty graph has no rows.
    """
    current = staging.write(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _checked(current)
    while before[0]:
        current = _star(_star(current, staging, large=True), staging, large=False)
        after = _checked(current)
        if after == before:
            break
        before = after
    return (
        current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        .unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("root")))
        .distinct()
    )
