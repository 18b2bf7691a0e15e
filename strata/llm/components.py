"""Distributed union-find: connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shared_checkpoint


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of an edge with the smallest node it can reach (the Kiveris et al. method).

    Node keys are long or string. Each step replaces the links of a node by links to the smallest node of its
    neighbourhood; star centres are aggregated with map-side combine, checkpointed, and joined back by a join
    that adaptive execution can split, so no centre's links meet in one task. Checkpoints lie in the
    cluster's shared folder. Self-links, repeated links and links with a null end are ignored.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = shared_checkpoint(e)
    before = None
    while True:
        # large star: every neighbour larger than u is linked to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        low = shared_checkpoint(low)
        e = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours are linked to the smallest of them
        e = shared_checkpoint(e.distinct())
        low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        e = (e.join(low, F.col("u") == F.col("k"))
             .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                       F.struct("u", F.col("m").alias("v")))).alias("e"))
             .select("e.u", "e.v").where("u != v").distinct())
        e = shared_checkpoint(e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
