"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import materialize


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the least node around it."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if large else both.where("v < u")
    # Written first: behind an aggregation in the same stage Spark could not split the join at a hub.
    least = materialize(around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")), label="least")
    chosen = around.where("v > u") if large else around.unionAll(around.select("u", F.col("u").alias("v")).distinct())
    moved = chosen.join(least, "u").select(F.col("least").alias("u"), "v").where("u <> v")
    return moved.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node of it) for every node of `edges` (u, v: longs).

    Null ends and loops are ignored. Nodes without edge are not in the result. Rounds grow with the logarithm
    of the longest chain; each is written to the shared folder.
    """
    edges = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    edges = materialize(edges, label="edges")
    state = None
    while True:
        edges = materialize(_starred(_starred(edges, True), False), label="stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    leaves = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return leaves.unionAll(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
