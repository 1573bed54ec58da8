"""Connected components of an edge table by alternating large-star and small-star steps.

Each step needs one minimum per node (aggregated before the shuffle) and one join on the node. The minima are
written first, so both sides of the join are plain exchanges and adaptive execution can split a hot hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm._shared import scratch, written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = written(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-sym")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-min")
    star = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return written(star.distinct(), "cc-large")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small", keep=True)


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(u, v) of longs -> (node, component): the least node reachable, for every node that has an edge.

    Loops and repeated edges are allowed, edges with a null end are left out, and an empty table gives an empty one.
    """
    spark = edges.sparkSession
    with scratch(spark):
        edges = written(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter(F.col("u") != F.col("v")).distinct(), "cc-edges")
        before = _signature(edges)
        while before[0]:
            with scratch(spark):
                edges = _small_star(_large_star(edges))
            after = _signature(edges)
            if after == before:
                break
            before = after
        roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        found = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
        return written(found, "cc-found", keep=True)
