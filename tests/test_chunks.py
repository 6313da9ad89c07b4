"""Vectors in chunks of bounded length."""

import pytest
from pyspark.sql import functions as F

from featureloom import chunk_values, chunks, long_positions, write_chunks


def test_round_trip_of_a_hot_key_in_many_tasks(spark, tmp_path):
    events = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("name"),
        F.xxhash64("id").alias("o"), F.when(F.col("id") % 11 > 0, F.col("id").cast("double")).alias("value"))
    long = long_positions(events, "name", "o", "value")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # partitions as dealt, not joined for being small
    try:
        written = spark.read.parquet(write_chunks(long, str(tmp_path / "v"), length=100))
        hot = written.filter("name = 'hot'")
        assert hot.count() == 100 and hot.select(F.input_file_name().alias("f")).distinct().count() == 8
        assert written.agg(F.max(F.size("values"))).first()[0] == 100 and written.filter("start % 100 <> 0").isEmpty()
        assert sorted(map(repr, chunk_values(written, "name").collect())) == sorted(map(repr, long.collect()))
        some = chunk_values(written, "name", 150, 349)
        assert sorted(map(repr, some.collect())) == sorted(map(repr, long.filter("pos between 150 and 349").collect()))
        assert "start" in str(some._jdf.queryExecution().executedPlan().toString()).split("PushedFilters")[1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_vectors_empty_ones_and_refusals(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1.0, None, 3.0]), ("b", []), (None, [4.0])], "name string, features array<double>")
    written = spark.read.parquet(write_chunks(rows, str(tmp_path / "v"), length=2))
    assert sorted(map(repr, map(tuple, written.collect()))) == sorted(map(repr, [("a", 0, [1.0, None]), ("a", 2, [3.0]), (None, 0, [4.0])]))
    assert spark.read.parquet(write_chunks(rows.filter("false"), str(tmp_path / "e"))).isEmpty()
    with pytest.raises(ValueError, match="length"):
        chunks(written, "name", 0)
