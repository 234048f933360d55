"""Connected components of an edge table, by alternating large and small stars.

Each round replaces edges by edges to the smallest neighbour, first among
larger nodes and then among smaller ones, until nothing moves; a component ends
as a star around its smallest node. Rounds are stored in the shared folder, so
lineage stays short. Nodes with very many edges only meet joins (which Spark
can split) and minimum aggregates (which are combined before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mixtape.session import stage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links each node's neighbours to its smallest neighbour or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = both.join(least, "u")
    if larger:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = (met.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node."""
    now = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")), "edges")
    seen = None
    while True:
        now = stage(_star(_star(now, larger=True), larger=False), "edges")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    centres = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
