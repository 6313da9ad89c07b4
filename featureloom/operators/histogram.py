"""Grouped histograms over fixed edges, dense vectors and the reject report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import bucket_index
from ..functions.cells import to_double
from ..functions.vectors import dense_from_sorted
from ..session import stage


def sparse_histogram(
    df: DataFrame, key: str, value: str, lo: float, hi: float, n: int = 200,
    keys: DataFrame | None = None,
) -> DataFrame:
    """``(key, bucket, n)`` per key and bucket.

    A key whose values are all outside the edges, or that only occurs in ``keys``, has one
    row with a null bucket and ``n = 0``. Counting is partial before the shuffle, so one key
    adds at most ``n + 1`` rows per map task whatever its share of the table.
    """
    rows = df.select(key, bucket_index(value, lo, hi, n).alias("bucket"))
    if keys is not None:
        rows = rows.unionByName(keys.select(key, F.lit(None).cast("int").alias("bucket")))
    return rows.groupBy(key, "bucket").agg(F.count("bucket").alias("n"))


def entries(counts: DataFrame, key: str, into: str = "entries") -> DataFrame:
    """The buckets of a key that are not empty, as a sorted array of ``(pos, n)``: a vector before it is made dense."""
    entry = F.when(F.col("bucket").isNotNull(), F.struct(F.col("bucket").alias("pos"), "n"))
    return counts.groupBy(key).agg(F.collect_list(entry).alias(into)).withColumn(into, F.sort_array(into))


def densify(counts: DataFrame, key: str, n: int, into: str = "features") -> DataFrame:
    """One dense ``array<bigint>`` per key from ``(key, bucket, n)`` rows.

    The grouped list holds at most ``n`` entries, one per bucket.
    """
    return entries(counts, key, "__e").select(key, dense_from_sorted("__e", n).alias(into))


def bucketize(
    df: DataFrame, key: str, value: str, lo: float, hi: float, n: int = 200,
    keys: DataFrame | None = None, into: str = "features",
) -> DataFrame:
    """Dense count vector of length ``n`` per key; a key without values is all zero."""
    return densify(sparse_histogram(df, key, value, lo, hi, n, keys), key, n, into)


def bucket_rejects(
    df: DataFrame, key: str, raw: str, lo: float, hi: float, n: int = 200
) -> DataFrame:
    """``(key, raw, n)``: values no bucket takes, with how often each occurs.

    Text that is no number and NaN are rejected as well. The list stays long: a key with
    many rejects is never gathered into one row.
    """
    return (
        df.select(key, F.col(raw).cast("string").alias("raw"))
        .filter(bucket_index(to_double("raw"), lo, hi, n).isNull())
        .groupBy(key, "raw")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bucket_summary(
    df: DataFrame, key: str, raw: str, lo: float, hi: float, n: int = 200
) -> DataFrame:
    """``(keys_ok, keys_with_rejects, rejected_values)`` over the whole table."""
    bad = bucket_index(to_double(raw), lo, hi, n).isNull()
    per_key = df.groupBy(key).agg(F.count_if(bad).alias("bad"))
    return per_key.agg(
        F.count_if(F.col("bad") == 0).alias("keys_ok"),
        F.count_if(F.col("bad") > 0).alias("keys_with_rejects"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("rejected_values"),
    )


def vector_long(df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """``(key, pos, value)``: one row per position, zeros included."""
    return df.select(key, F.posexplode(features).alias("pos", "value"))


def chunks(long: DataFrame, key: str, length: int = 1024) -> DataFrame:
    """``(key, start, values)`` of long rows ``(key, pos, value)``: values in the order of ``pos``, at most ``length`` a row."""
    if length < 1:
        raise ValueError(f"length must be 1 or more, not {length}")
    start = (F.col("pos") - F.pmod("pos", F.lit(length))).cast("bigint").alias("start")
    rows = long.groupBy(key, start).agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("__v"))
    return rows.select(key, "start", F.transform("__v", lambda v: v["value"]).alias("values"))


def chunk_values(chunked: DataFrame, key: str, first: int = 0, last: int | None = None) -> DataFrame:
    """``(key, pos, value)`` of the positions ``first`` to ``last`` (inclusive; default: all) of every vector in chunks.

    Rows of other positions are left out by ``start``, which the scan of a written table sees.
    """
    rows = chunked if last is None else chunked.filter(F.col("start") <= last)
    rows = rows.filter(F.col("start") + F.size("values") > first)
    long = rows.select(key, "start", F.posexplode("values").alias("__i", "value"))
    long = long.select(key, (F.col("start") + F.col("__i")).alias("pos"), "value")
    return long.filter(F.col("pos") >= first) if last is None else long.filter(F.col("pos").between(first, last))


def long_positions(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``(key, pos, value)`` of every row, numbered from 0 within its key by ``order``.

    Rows are dealt to ranges of (key, order) and written, so that a range keeps its number. A range numbers its
    own rows; what stands before it comes from counts per (key, range), so no task holds a whole key.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias(key), F.col(order).alias("__o"), F.col(value).alias("value"))
    ranged = stage(rows.repartitionByRange(n, key, "__o").withColumn("__r", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(key).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(key, "__r").agg(F.count("*").alias("__n"))
    starts = starts.select(F.col(key).alias("__k"), F.col("__r").alias("__q"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    inside = F.row_number().over(Window.partitionBy(key, "__r").orderBy("__o")) - 1
    out = ranged.withColumn("__i", inside).join(starts, (F.col("__r") == F.col("__q")) & F.col(key).eqNullSafe(F.col("__k")))
    return out.select(key, (F.col("__s") + F.col("__i")).alias("pos"), "value")
