"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Workspace


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger (or else smaller) neighbours to its least one.

    The least neighbour is found with map-side aggregation; the join back has
    one row per node on one side, so Spark can split the edges of a hub.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if larger:
        out = (
            both.filter("v > u")
            .join(least.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
    else:
        out = (
            both.join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        )
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """Per node with an edge its component: (node, root), root the least node.

    ``edges`` has two long columns a and b. Rounds repeat until every node
    hangs on its root; each is written to the workspace, so a lost executor
    re-reads files. Only a count and a sum reach the driver.
    """
    a, b = edges.columns
    state = workspace.store(
        edges.select(
            F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
        ).filter("a <> b").distinct(),
        "edges",
    )
    seen = None
    while True:
        state = workspace.store(_stars(_stars(state, True), False), "edges")
        # Stars are a fixed point: the same edges come out again.
        now = state.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s"),
        ).first()
        if now == seen or now["n"] == 0:
            break
        seen = now
    roots = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
