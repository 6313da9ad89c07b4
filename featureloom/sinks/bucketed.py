"""Tables bucketed and sorted by name, so that fusion and label join need no exchange.

A matrix that is joined again and again (other labels, other partners) pays for its shuffle once, when it is written.
Files lie below the shared folder or at a path of the caller; the session catalog holds their names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import named
from ..operators.assembly import attach_labels
from ..session import scratch_dir

KEY = "__key"
# A name with more distinct labels than this is no longer joined within its bucket.
HOT = 10_000


def _key(name: Column) -> Column:
    """Text that is never null and differs for names that differ, so that a null name equals a null one by plain equality."""
    return F.coalesce(F.concat(F.lit("v"), name.cast("string")), F.lit("n"))


def write_bucketed(df: DataFrame, key: str = "name", buckets: int | None = None, path: str | None = None) -> DataFrame:
    """``df`` in ``buckets`` files by hash of ``key``, each sorted; returns the table as it is read back, with the bucket key ``__key``.

    Tables that are to be joined need the same number of buckets (default: the shuffle partitions). ``__key`` is taken as a name.
    """
    spark = df.sparkSession
    if KEY in df.columns:
        raise ValueError(f"the column name {KEY} is taken")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    # Dealt as the buckets are, so that a bucket is one file.
    dealt = df.withColumn(KEY, _key(named(key))).repartition(n, KEY)
    writer = dealt.write.format("parquet").option("path", path or scratch_dir(spark, "bucketed"))
    writer.bucketBy(n, KEY).sortBy(KEY).saveAsTable(name)
    return spark.table(name)


@dataclass
class BucketedLabels:
    """Labels counted by name: ``rows`` in buckets (``__key``, ``label``, ``k``), ``hot`` the names with very many labels (null if none)."""

    rows: DataFrame
    hot: DataFrame | None


def write_bucketed_labels(
    labels: DataFrame, key: str, label: str, *, buckets: int | None = None, hot: int = HOT, keep_null: bool = True,
) -> BucketedLabels:
    """Distinct labels of each name with their count ``k``, in buckets by name.

    Counting comes before the shuffle, so rows that repeat name and label never meet in number. Names with over ``hot``
    distinct labels go to a table of their own, in no buckets, whose join adaptive execution may split.
    """
    counted = labels.groupBy(F.col(key).alias("name"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("k"))
    if not keep_null:
        counted = counted.filter("label IS NOT NULL")
    written = write_bucketed(counted, "name", buckets)
    many = written.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select(KEY)
    if many.isEmpty():
        return BucketedLabels(written.drop("name"), None)
    apart = written.join(many, KEY, "left_semi").select(KEY, "label", "k")
    rest = written.join(many, KEY, "left_anti").drop("name")
    return BucketedLabels(rest, apart)


def _labelled(vectors: DataFrame, labels: BucketedLabels, keep_unlabelled: bool) -> DataFrame:
    """``vectors`` with ``label`` and ``k``; without a label both are null."""
    joined = vectors.join(labels.rows, KEY, "left" if keep_unlabelled else "inner")
    if labels.hot is None:
        return joined
    if keep_unlabelled:  # the names of the hot table have labels, only not here
        joined = joined.join(labels.hot.select(KEY).distinct(), KEY, "left_anti")
    pairs = labels.hot.select(KEY, F.struct("label", "k").alias("__l"))
    spread = attach_labels(vectors.join(pairs.select(KEY).distinct(), KEY, "left_semi"), pairs, KEY, "__l")
    rest = [c for c in vectors.columns if c != KEY]
    spread = spread.select(KEY, *rest, F.col("label")["label"].alias("label"), F.col("label")["k"].alias("k"))
    return joined.select(*spread.columns).unionByName(spread)


def attach_bucketed(vectors: DataFrame, labels: BucketedLabels, keep_unlabelled: bool = False, name: str = "name") -> DataFrame:
    """``(name, label, …rest, copies)`` of bucketed vectors; ``copies`` counts equal rows of the label side."""
    rest = [c for c in vectors.columns if c not in (KEY, name)]
    joined = _labelled(vectors, labels, keep_unlabelled)
    if not keep_unlabelled:
        joined = joined.filter("label IS NOT NULL")
    return joined.select(name, "label", *rest, F.coalesce("k", F.lit(1)).cast("bigint").alias("copies"))


def fuse_bucketed(
    *vectors: DataFrame, labels: BucketedLabels | None = None, keep_unlabelled: bool = False, name: str = "name", features: str = "features",
) -> DataFrame:
    """Vectors of the names that all tables have, end to end: ``(name, features)``, with labels ``(name, label, features, copies)``.

    The tables come from :func:`write_bucketed`, one row for each name. As in fusing labelled matrices on name and label, a
    label that occurs ``k`` times under a name stands for ``k`` to the number of tables equal rows, told by ``copies``.
    """
    if len(vectors) < 2:
        raise ValueError("fusion needs two tables or more")
    sides = [v.select(KEY, *([name] if i == 0 else []), F.col(features).alias(f"__f{i}")) for i, v in enumerate(vectors)]
    fused = reduce(lambda a, b: a.join(b, KEY), sides)
    parts = [f"__f{i}" for i in range(len(vectors))]
    if labels is None:
        return fused.select(name, F.concat(*parts).alias(features))
    joined = _labelled(fused, labels, keep_unlabelled)
    if not keep_unlabelled:
        joined = joined.filter("label IS NOT NULL")
    copies = reduce(lambda a, b: a * b, [F.coalesce("k", F.lit(1)).cast("bigint")] * len(vectors))
    return joined.select(name, "label", F.concat(*parts).alias(features), copies.alias("copies"))


def drop_bucketed(spark: SparkSession) -> None:
    """Take the names of all bucketed tables of this session out of its catalog; files at paths of the caller stay."""
    for t in spark.catalog.listTables():
        if t.name.startswith("bucketed_"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
