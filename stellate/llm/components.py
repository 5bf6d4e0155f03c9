"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root being the
    smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones,
    on the smallest neighbour; it ends when the edges are stars. Rounds grow
    with the logarithm of a component's size, edges never grow in number, and
    a node's neighbours are never gathered: their minimum is an aggregate.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = stored(pairs.distinct(), "edges")
    before = None
    while True:
        state = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == before or state.n == 0:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = state
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select("b", "low").union(low).toDF("a", "b")
        pairs = stored(small.distinct(), "edges")
