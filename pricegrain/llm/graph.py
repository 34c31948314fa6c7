"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import materialize


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star method over (u, v) with v < u: hang neighbours on the least one."""
    if large:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        hung = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return hung.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of an edge: root is the smallest node of its component.

    ``edges`` has columns a, b of one orderable type. Alternating large-star and small-star steps, each
    round written to the shared folder, until one changes nothing, however many that takes. No neighbour list is built:
    minima are aggregated before the shuffle, and hot nodes meet only joins that Spark can split.
    """
    e = materialize(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = now = None
    while now is None or now != state:
        state = now
        e = materialize(star(star(e, large=True), large=False), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
