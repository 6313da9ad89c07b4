"""Bucket edges, exact assignment, histograms and rejects."""

import bisect

import pytest
from pyspark.sql import functions as F

from featureloom import PRESETS, bucket_edges, bucket_index, bucket_rejects, bucketize
from featureloom.functions.cells import to_double


@pytest.mark.parametrize("axis", sorted(PRESETS))
def test_all_two_decimal_values(spark, axis):
    """Every two-decimal value on and around the axis, against a search in the edges."""
    lo, hi, n = PRESETS[axis]
    edges = bucket_edges(lo, hi, n)
    assert len(edges) == n + 1 and edges[0] == lo and edges[-1] == hi
    first, last = int(lo * 100) - 200, int(hi * 100) + 200
    rows = spark.range(first, last + 1).select((F.col("id") / 100).alias("v"))
    for v, got in rows.select("v", bucket_index("v", lo, hi, n)).collect():
        want = None if v < lo or v > hi else min(bisect.bisect_right(edges, v) - 1, n - 1)
        assert got == want, v


def test_special_values(spark):
    cases = [("-1", 0), ("-0.66", 3), ("16", 199), ("16.01", None), ("-1.01", None), ("nan", None),
             ("abc", None), ("", None), ("1.0d", None), ("1_0", None), (" 0.02 ", 11), ("inf", None)]
    df = spark.createDataFrame(cases, "raw string, want int")
    for raw, want, got in df.select("raw", "want", bucket_index(to_double("raw"), *PRESETS["1H"])).collect():
        assert got == want, raw


def test_bad_axis():
    with pytest.raises(ValueError):
        bucket_edges(1, 1, 10)


def test_histogram_and_rejects_cover_all_values(spark):
    df = spark.range(2000).select(
        # One key holds most rows.
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("name"),
        ((F.col("id") * 37) % 300 - 20).cast("string").alias("raw"),
    )
    keys = spark.createDataFrame([("hot",), ("empty",)], "name string")
    vectors = bucketize(df.withColumn("v", to_double("raw")), "name", "v", 0, 250, 200, keys=keys)
    rows = {r.name: r.features for r in vectors.collect()}
    assert rows["empty"] == [0] * 200
    assert all(len(v) == 200 for v in rows.values())
    rejected = bucket_rejects(df, "name", "raw", 0, 250).agg(F.sum("n")).first()[0]
    assert sum(map(sum, rows.values())) + rejected == 2000


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select((F.col("id") % 5).alias("k"), (F.col("id") % 97 / 4).alias("v"))
    one = {r.k: r.features for r in bucketize(df.coalesce(1), "k", "v", 0, 20, 40).collect()}
    many = {r.k: r.features for r in bucketize(df.repartition(13), "k", "v", 0, 20, 40).collect()}
    assert one == many
