"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import staged


def _round(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over edges ``(a, b)`` with ``a > b``.

    Large: every larger neighbour of a node is linked to the least of its neighbourhood.
    Small: every smaller neighbour and the node itself are. Both keep the components. The least
    neighbour is an aggregate that is combined before the shuffle, and the join that brings it back
    is an inner one, so a node with very many links is split by adaptive execution.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).withColumn("low", F.least("node", "low"))
    met = both.join(least, F.col("a") == F.col("node"))
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return out.where("a > b").distinct()
    out = met.select(F.col("b").alias("a"), F.col("low").alias("b"))
    out = out.union(least.select(F.col("node").alias("a"), F.col("low").alias("b")))
    return out.where("a > b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node reachable.

    Loops, repeated and reversed edges are allowed; edges with a null end are dropped; without edges
    there are no rows. Each round is written to the shared folder; the rounds end when every node
    is linked to a root alone, which takes about as many rounds as the logarithm of the
    largest component squared, in practice its logarithm.
    """
    tidy = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now = staged(tidy, "links")
    while True:
        now = staged(_round(_round(now, True), False), "links")
        # stars: no node has two links, and no node is both linked and a root
        bad = now.groupBy("a").count().where("count > 1").select("a")
        inner = now.select("a").join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if bad.union(inner).limit(1).count() == 0:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
