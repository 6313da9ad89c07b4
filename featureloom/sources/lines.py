"""Line numbers of text files, without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_lines(text: DataFrame, keep: Column | None = None) -> DataFrame:
    """``(file, line_no, value)`` of a ``spark.read.text`` table; ``line_no`` starts at 0.

    Row ids are consecutive within a split. One aggregate counts the lines of every split, a
    window over the splits of a file (never over its lines) adds up what comes before, and
    the kept lines pick up the offset of their split.
    """
    rows = text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        rows.groupBy("file", "start")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .select("file", "start", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    if keep is not None:
        rows = rows.filter(keep)
    return rows.join(splits, ["file", "start"]).select(
        "file", (F.col("before") + F.col("id") - F.col("first_id")).alias("line_no"), "value"
    )
