"""Connected parts of graphs in node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dealt, stage


def _stars(pairs: DataFrame) -> DataFrame:
    """One round on pairs ``(graph_id, hi, lo)``: all neighbours are hung on the least one, from above and then from below."""
    both = pairs.select("graph_id", F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        pairs.select("graph_id", F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("graph_id", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    above = both.join(dealt(least), ["graph_id", "u"]).filter("v > u").select("graph_id", F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    floor = above.groupBy("graph_id", "hi").agg(F.min("lo").alias("m"))
    below = above.join(dealt(floor), ["graph_id", "hi"])
    return below.select("graph_id", F.inline(F.array(
        F.struct("lo", "m"), F.struct(F.col("hi").alias("lo"), "m")
    ))).filter("lo <> m").select("graph_id", F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()


def node_fragments(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(graph_id, node_id, fragment)``: the least node that can be reached, the node itself included.

    Rounds of star contraction until nothing changes; their number grows with the logarithm of the longest path, and each
    is written, so a lost executor costs one round. All joins are on (graph, node). Links to ids that are no nodes, loops and null
    ids connect nothing.
    """
    known = nodes.select("graph_id", "node_id").distinct()
    end = lambda name: dealt(known.withColumnRenamed("node_id", name))
    pairs = (
        edges.filter("src <> dst").select("graph_id", F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .distinct().join(end("hi"), ["graph_id", "hi"], "left_semi").join(end("lo"), ["graph_id", "lo"], "left_semi")
        .select("graph_id", "hi", "lo")
    )
    pairs = stage(pairs, "pairs")
    while True:
        after = stage(_stars(pairs), "stars")
        # Equal numbers of distinct pairs, and none that is new: nothing has changed.
        if after.count() == pairs.count() and after.join(dealt(pairs), ["graph_id", "hi", "lo"], "left_anti").isEmpty():
            break
        pairs = after
    found = pairs.select("graph_id", F.col("hi").alias("node_id"), F.col("lo").alias("fragment"))
    return known.join(dealt(found), ["graph_id", "node_id"], "left").withColumn("fragment", F.coalesce("fragment", "node_id"))


def graph_fragments(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(graph_id, fragments)``: how many connected parts every graph has; more than one makes it disconnected."""
    tops = node_fragments(nodes, edges).filter(F.col("fragment") == F.col("node_id"))
    return tops.groupBy("graph_id").agg(F.count(F.lit(1)).alias("fragments"))
