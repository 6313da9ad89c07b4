"""Labels, fusion, sinks and the named modes."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from featureloom import (
    append_log, as_dataframe, attach_labels, drop_null_features, expand_copies, fuse,
    hybrid_matrix, order_like_files, pad_vectors, ragged_vectors, read_vectors,
    reject_degenerate, spectral_matrix, split_meta, stack_vectors, write_matrix, write_vectors,
    write_verified,
)
from featureloom.catalog import QUERIES
from featureloom.operators.histogram import long_positions
from featureloom.session import scratch_dir
from featureloom.sinks.tables import matrix_path, verified_path


def vectors(spark, rows):
    return spark.createDataFrame(rows, "name string, features array<bigint>")


def labels(spark, rows):
    return spark.createDataFrame(rows, "name string, y double")


def test_repeated_and_missing_labels(spark):
    m = vectors(spark, [("a", [1, 2]), ("b", [3, 4]), ("c", [5, 6])])
    y = labels(spark, [("a", 1.0), ("a", 2.0), ("b", None)])
    got = sorted(tuple(r) for r in attach_labels(m, y, "name", "y").collect())
    assert got == [("a", 1.0, [1, 2]), ("a", 2.0, [1, 2])]
    kept = attach_labels(m, y, "name", "y", keep_unlabelled=True)
    assert sorted((r.name, r.label) for r in kept.collect() if r.label is None) == [("b", None), ("c", None)]
    assert kept.count() == 4
    y = y.withColumn("o", -y.y)
    first = attach_labels(m, y, "name", "y", labels_mode="first", order=["o"])
    assert [tuple(r)[:2] for r in first.collect()] == [("a", 2.0)]


def test_fusion_counts_copies(spark):
    schema = "name string, label double, features array<bigint>"
    h = spark.createDataFrame([("a", 1.0, [1])] * 3 + [("a", None, [1]), ("b", 2.0, [2])], schema)
    c = spark.createDataFrame([("a", 1.0, [9])] * 2 + [("a", None, [8]), ("z", 2.0, [2])], schema)
    fused = fuse(h, c)
    got = {(r.name, r.label): (r.features, r.copies) for r in fused.collect()}
    assert got == {("a", 1.0): ([1, 9], 6), ("a", None): ([1, 8], 1)}
    assert expand_copies(fused).count() == 7


def test_expand_many_copies(spark):
    df = spark.createDataFrame([("a", 25_001), ("b", 10_000), ("c", 1)], "name string, copies bigint")
    got = {r.name: r["count"] for r in expand_copies(df).groupBy("name").count().collect()}
    assert got == {"a": 25_001, "b": 10_000, "c": 1}


def test_hybrid_equals_fusing_labelled_matrices(spark):
    h = vectors(spark, [("a", [1]), ("b", [2]), ("c", [3])])
    c = vectors(spark, [("a", [4]), ("b", [5]), ("d", [6])])
    y = labels(spark, [("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", None), ("c", 1.0)])
    for keep in (False, True):
        short = hybrid_matrix(h, c, y, label="y", keep_unlabelled=keep)
        sides = [attach_labels(v, y, "name", "y", keep_unlabelled=keep) for v in (h, c)]
        key = lambda d: sorted(map(repr, d.select("name", "label", "features", "copies").collect()))
        assert key(short) == key(fuse(*sides))


def test_ragged_padding_and_null_features(spark):
    a = vectors(spark, [("a", [1, 2, 3]), ("b", [1])])
    b = spark.createDataFrame([("c", 1.0)], "name string, label double")
    both = stack_vectors(a, b)
    whole, other = ragged_vectors(both, 3)
    assert [r.name for r in whole.collect()] == ["a"]
    assert sorted(r.name for r in other.collect()) == ["b", "c"]
    padded = pad_vectors(a, 3)
    assert {r.name: r.features for r in padded.collect()} == {"a": [1, 2, 3], "b": [1, None, None]}
    labelled = attach_labels(padded, labels(spark, [("a", 1.0), ("b", 1.0)]), "name", "y")
    assert [r.name for r in drop_null_features(labelled, 3).collect()] == ["a"]


def test_empty_spectrum_and_sink(spark, tmp_path):
    values = spark.createDataFrame([("a", 0.02), ("a", 16.0), ("x", 99.0)], "name string, value double")
    names = spark.createDataFrame([("a",), ("a-1",), ("a_1",), ("a1",)], "name string")
    y = labels(spark, [(n, 1.5) for n in ("a", "a-1", "a_1", "a1")])
    m = spectral_matrix(values, names, y, "1H", label="y")
    path = write_matrix(m, str(tmp_path / "m"), 200, ordered=True)
    rows = []
    for part in sorted(glob.glob(path + "/part-*.csv")):
        with open(part, newline="") as f:
            head, *body = list(csv.reader(f)) or [[]]
            rows += body
    assert head[:3] == ["MOLECULE_NAME", "LABEL", "FEATURE_1"] and len(head) == 202
    assert [r[0] for r in rows] == ["a-1", "a", "a1", "a_1"]
    assert sum(map(int, rows[0][2:])) == 0 and sum(map(int, rows[1][2:])) == 2
    back = split_meta(as_dataframe(spark, path))
    assert {r.MOLECULE_NAME: len(r.features) for r in back.collect()} == dict.fromkeys(["a", "a-1", "a1", "a_1"], 200)
    assert as_dataframe(spark, m) is m
    assert [r.name for r in order_like_files(names, "name").collect()] == ["a-1", "a", "a1", "a_1"]


def test_quotes_survive_the_sink(spark, tmp_path):
    m = vectors(spark, [('x"1", y', [1])]).selectExpr("name", "1.0 AS label", "features", "3L AS copies")
    back = as_dataframe(spark, write_matrix(m, str(tmp_path / "m"), 1)).collect()
    assert [r.MOLECULE_NAME for r in back] == ['x"1", y'] * 3


def test_long_positions_number_every_row_of_a_hot_key(spark, tmp_path):
    rows = [("hot", i * 7 % 3001, float(i)) for i in range(3001)] + [("a", 5, 1.0), ("a", 2, None), (None, 1, 4.0)]
    df = spark.createDataFrame(rows, "name string, at long, v double")
    got = spark.read.parquet(write_vectors(long_positions(df, "name", "at", "v"), str(tmp_path / "v")))
    want = [("hot", at, v) for _, at, v in rows[:3001]] + [("a", 0, None), ("a", 1, 1.0), (None, 0, 4.0)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    ranges = long_positions(df, "name", "at", "v").select(F.spark_partition_id()).distinct().count()
    assert ranges > 1


def test_long_vectors_hold_every_event(spark, tmp_path):
    events = spark.range(500).select((F.col("id") % 3 * 0).alias("user_id"), F.col("id").alias("event_id"), (F.col("id") * 0.5).alias("value"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["long_vectors_whole"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("0", i, i * 0.5) for i in range(500)]


def test_other_sinks(spark, tmp_path):
    assert verified_path("/d/test.csv") == "/d/test_verified.csv"
    assert matrix_path("/o", "/d/test_verified.csv", "1H") == "/o/test_1H_ML_input.csv"
    m = vectors(spark, [("a", [7, 8])])
    long = spark.read.parquet(write_vectors(m, str(tmp_path / "v")))
    assert sorted(map(tuple, long.collect())) == [("a", 0, 7), ("a", 1, 8)]
    log = spark.createDataFrame([("a", ["r1", "r2"])], "name string, reasons array<string>")
    for _ in range(2):
        append_log(log, str(tmp_path / "log"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [("a", "r1, r2")] * 2
    write_verified(m.select("name"), str(tmp_path / "t.csv"))
    with pytest.raises(ValueError):
        write_verified(m, str(tmp_path / "u"), fmt="xml")


def test_vector_files(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("1\n2\n3\n")
    (tmp_path / "long.csv").write_text("1\n" * 9)
    (tmp_path / "text.csv").write_text("1\nx\n3\n")
    (tmp_path / "note.txt").write_text("1\n2\n3\n")
    got, rest = read_vectors(spark, str(tmp_path), 3)
    assert [tuple(r) for r in got.collect()] == [("a b", [1.0, 2.0, 3.0])]
    assert sorted((r.name, r.length, r.numbers) for r in rest.collect()) == [("long", 9, 9), ("text", 3, 2)]


def test_degenerate_points(spark):
    df = spark.createDataFrame([(1, [[0.0, 0.05], [0.0, 0.0]]), (2, [[0.0, 0.0], [1.0, 0.0]])], "id int, p array<array<double>>")
    kept, gone = reject_degenerate(df, "p")
    assert [r.id for r in kept.collect()] == [2] and [r.id for r in gone.collect()] == [1]


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base + "/x-")
