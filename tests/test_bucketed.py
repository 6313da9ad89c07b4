"""Bucketed tables: no exchange above the scans, and the rows of the joins that shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from featureloom import (
    attach_bucketed, attach_labels, drop_bucketed, expand_copies, fuse, fuse_bucketed, write_bucketed, write_bucketed_labels,
)

VECTOR = "name string, features array<double>"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    drop_bucketed(spark)


def tables(spark, seed=5):
    rng = random.Random(seed)
    names = [None, "", "n", *[f"m{i}" for i in range(60)]]
    a = [(n, [float(i), 1.0]) for i, n in enumerate(names) if i % 5]
    b = [(n, [float(-i)]) for i, n in enumerate(names) if i % 7]
    b, a = b + [(None, [0.5])], a + [(None, [9.0, 9.0])]
    labels = [(rng.choice(names[:40]), rng.choice(["x", "y", None])) for _ in range(300)] + [("m3", f"l{i}") for i in range(30)]
    return spark.createDataFrame(a, VECTOR), spark.createDataFrame(b, VECTOR), spark.createDataFrame(labels, "name string, label string")


def rows(df):
    return sorted(map(repr, df.collect()))


def shuffles(df):
    return str(df._jdf.queryExecution().executedPlan().toString()).count("Exchange ")


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("hot", [10_000, 5])
def test_fused_rows_are_those_of_the_labelled_matrices(no_broadcast, keep, hot):
    a, b, labels = tables(no_broadcast)
    left, right = (attach_labels(x, labels, "name", "label", keep_unlabelled=keep) for x in (a, b))
    want = expand_copies(fuse(left, right))
    counted = write_bucketed_labels(labels, "name", "label", hot=hot)
    assert (counted.hot is None) == (hot > 100)
    got = fuse_bucketed(write_bucketed(a), write_bucketed(b), labels=counted, keep_unlabelled=keep)
    assert rows(expand_copies(got).select(want.columns)) == rows(want)
    if hot > 100:
        assert shuffles(got) == 0, got._jdf.queryExecution().toString()


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("hot", [10_000, 5])
def test_labels_attach_without_an_exchange(no_broadcast, keep, hot):
    a, _, labels = tables(no_broadcast, 8)
    want = attach_labels(a, labels, "name", "label", keep_unlabelled=keep)
    got = attach_bucketed(write_bucketed(a), write_bucketed_labels(labels, "name", "label", hot=hot), keep_unlabelled=keep)
    assert rows(expand_copies(got)) == rows(want)
    if hot > 100:
        assert shuffles(got) == 0


def test_numbers_as_names_empty_tables_and_refusals(no_broadcast):
    a = no_broadcast.createDataFrame([(1, [1.0]), (None, [2.0])], "name long, features array<double>")
    fused = fuse_bucketed(write_bucketed(a), write_bucketed(a))
    assert rows(fused) == rows(no_broadcast.createDataFrame([(1, [1.0, 1.0]), (None, [2.0, 2.0])], "name long, features array<double>"))
    none = a.filter("false")
    assert fuse_bucketed(write_bucketed(a), write_bucketed(none)).count() == 0
    labels = write_bucketed_labels(none.select("name", F.lit("x").alias("label")), "name", "label")
    assert attach_bucketed(write_bucketed(a), labels).count() == 0
    assert attach_bucketed(write_bucketed(a), labels, keep_unlabelled=True).select("copies").distinct().collect()[0].copies == 1
    with pytest.raises(ValueError, match="taken"):
        write_bucketed(a.withColumn("__key", F.lit(1)))
    with pytest.raises(ValueError, match="two tables"):
        fuse_bucketed(write_bucketed(a))
