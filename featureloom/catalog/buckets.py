"""Bucketing and dense vectors over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.buckets import PRESETS
from ..operators import histogram as H
from .common import query, table

LO, HI, N = 0.0, 250.0, 200

# The buckets stated as half-open ranges, joined by range; the last one includes its top.
RANGES = """
  SELECT i::INTEGER AS bucket, i::DOUBLE * 1.25::DOUBLE AS e0,
         CASE WHEN i = 199 THEN 250::DOUBLE ELSE (i + 1)::DOUBLE * 1.25::DOUBLE END AS e1
  FROM range(200) r(i)"""
IN_RANGE = "value >= e0 AND (value < e1 OR (bucket = 199 AND value <= e1))"


@query(f"""
WITH b AS ({RANGES})
SELECT user_id, bucket, count(*) AS n FROM events JOIN b ON {IN_RANGE}
GROUP BY user_id, bucket
""")
def bucket_histogram(spark, d):
    counts = H.sparse_histogram(table(spark, d, "events"), "user_id", "value", LO, HI, N)
    return counts.filter("bucket IS NOT NULL").select("user_id", "bucket", "n")


@query("""
SELECT user_id, value::VARCHAR AS raw, count(*) AS n FROM events
WHERE value < 0 OR value > 250 GROUP BY ALL
""")
def bucket_rejects(spark, d):
    return H.bucket_rejects(table(spark, d, "events"), "user_id", "value", LO, HI, N)


@query("""
WITH k AS (SELECT user_id, count(*) FILTER (WHERE value < 0 OR value > 250) AS bad
           FROM events GROUP BY user_id)
SELECT count(*) FILTER (WHERE bad = 0) AS keys_ok, count(*) FILTER (WHERE bad > 0) AS keys_with_rejects,
       sum(bad)::BIGINT AS rejected_values FROM k
""")
def bucket_summary(spark, d):
    return H.bucket_summary(table(spark, d, "events"), "user_id", "value", LO, HI, N)


@query(f"""
WITH b AS ({RANGES}), h AS (
  SELECT user_id, bucket, count(*) AS n FROM events JOIN b ON {IN_RANGE} GROUP BY ALL),
keys AS (SELECT user_id FROM events UNION SELECT c_custkey FROM customer)
SELECT keys.user_id, b.bucket AS pos, coalesce(h.n, 0) AS value
FROM keys CROSS JOIN b LEFT JOIN h ON h.user_id = keys.user_id AND h.bucket = b.bucket
""")
def dense_vectors(spark, d):
    """Every customer has a vector, those without events an all-zero one."""
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    vectors = H.bucketize(table(spark, d, "events"), "user_id", "value", LO, HI, N, keys=keys)
    return H.vector_long(vectors, "user_id")


@query("""
WITH p(preset, lo, hi) AS (VALUES ('1H', -1::DOUBLE, 16::DOUBLE), ('13C', -10::DOUBLE, 230::DOUBLE)),
b AS (SELECT preset, i::INTEGER AS bucket, i::DOUBLE * ((hi - lo) / 200) + lo AS e0,
             CASE WHEN i = 199 THEN hi ELSE (i + 1)::DOUBLE * ((hi - lo) / 200) + lo END AS e1
      FROM p, range(200) r(i))
SELECT preset, event_type, bucket, count(*) AS n FROM events
JOIN b ON value >= e0 AND (value < e1 OR (bucket = 199 AND value <= e1)) GROUP BY ALL
""")
def preset_histograms(spark, d):
    """Both spectral presets over the same values."""
    events = table(spark, d, "events")
    parts = [
        H.sparse_histogram(events, "event_type", "value", *axis)
        .filter("bucket IS NOT NULL")
        .select(F.lit(name).alias("preset"), "event_type", "bucket", "n")
        for name, axis in PRESETS.items()
    ]
    return parts[0].unionByName(parts[1])
