"""Scan of vector files: one number per line, the key in the file path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import to_double
from .lines import number_lines

# Key = file name without its extension.
FILE_NAME = r"([^/]+)\.csv$"


def read_vector_values(spark: SparkSession, path: str, key_pattern: str = FILE_NAME) -> DataFrame:
    """``(name, file, pos, raw, value)`` of all files in one read; ``value`` is null for non-numbers."""
    lines = number_lines(spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).text(path))
    name = F.regexp_extract(F.url_decode("file"), key_pattern, 1)
    return lines.select(
        name.alias("name"), "file", F.col("line_no").alias("pos"),
        F.col("value").alias("raw"), to_double("value").alias("value"),
    )


def read_vectors(
    spark: SparkSession, path: str, n: int, key_pattern: str = FILE_NAME
) -> tuple[DataFrame, DataFrame]:
    """``(vectors, rejects)``: dense ``features`` per file of ``n`` numbers, and the rest.

    A key that several files have is rejected, whatever their lengths; ``files`` counts them.

    Only the first ``n`` positions are gathered, so a file of any length adds at most ``n``
    entries; its full length is counted and decides whether it is a vector at all.
    """
    values = read_vector_values(spark, path, key_pattern)
    entry = F.when((F.col("pos") < n) & F.col("value").isNotNull(), F.struct("pos", "value"))
    per_file = values.groupBy("name", "file").agg(
        F.count(F.lit(1)).alias("length"),
        F.count("value").alias("numbers"),
        F.sort_array(F.collect_list(entry)).alias("entries"),
    )
    packed = per_file.groupBy("name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("length"),
        F.sum("numbers").alias("numbers"), F.min_by("entries", "file").alias("entries"),
    )
    whole = (F.col("files") == 1) & (F.col("length") == n) & (F.col("numbers") == n)
    vectors = packed.filter(whole).select("name", F.col("entries")["value"].alias("features"))
    return vectors, packed.filter(~whole).select("name", "length", "numbers", "files")
