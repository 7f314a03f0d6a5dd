"""Connected components by alternating star contraction on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.frames import freeze


def _open_nodes(e: DataFrame) -> int:
    """Nodes that keep the edges from being a forest of stars."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        e.select(F.col("v").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    return ends.groupBy("n").agg(F.sum("low").alias("low"), F.max("high").alias("high")) \
        .where("low > 1 OR low = 1 AND high = 1").count()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b): the smallest id it can reach.

    Large star and small star steps in turn until each node hangs on its root;
    each round is written to the shared folder.  Minima are combined before the
    shuffle and the joins are plain equi-joins, so a hub is split by adaptive
    skew handling.
    """
    e = freeze(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                            F.least("a", "b").alias("v")).distinct(), "edges")
    while _open_nodes(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, both["u"] == least["k"]).where("v > u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        hung = large.join(least, large["u"] == least["k"])
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        e = freeze(small, "edges")
    leaves = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
