"""The four modes end to end on an invented table."""

import csv
import glob

import pytest
from pyspark.sql import functions as F
from test_ingest import SAMPLE, put

from featureloom import (
    build_matrix, circular_signatures, distinct_records, expand_implicit, fit_backoff,
    notation_to_graph, run_mode, signature_levels, verify_table,
)


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    extra = "bad-1;C1CC;1,0\nw-03;CCO;9,99\nsalt;[Na+].[Cl-];0,5\n"
    return put(folder, SAMPLE + extra)


@pytest.fixture(scope="module")
def shifts(spark, source):
    """Reference values per element, made up as the number of the atom in its molecule."""
    records = distinct_records(verify_table(spark, source).rows)
    nodes, edges = expand_implicit(*notation_to_graph(records, "name", "notation")[:2])
    known = nodes.withColumn("v", F.abs("node_id") % 15 + F.lit(0.5))
    sigs = circular_signatures(nodes, edges, 2, typed=True)
    train = sigs.join(known.select("graph_id", "node_id", "label", "v"), ["graph_id", "node_id"])
    return {
        mode: fit_backoff(train.filter(F.col("label") == x), signature_levels(2), "v")
        for mode, x in (("1H", "H"), ("13C", "C"))
    }


@pytest.mark.parametrize("mode,width", [("1H", 202), ("13C", 202), ("FP", 2050), ("hybrid", 402)])
def test_mode(spark, source, shifts, tmp_path, mode, width):
    out = run_mode(spark, source, mode, str(tmp_path), 3, shifts=shifts)
    assert out.endswith(f"in_{'HYBRID' if mode == 'hybrid' else mode}_ML_input.csv")
    rows = []
    for part in sorted(glob.glob(out + "/part-*.csv")):
        with open(part, newline="") as f:
            head, *body = list(csv.reader(f)) or [[]]
            rows += body
    assert len(head) == width and head[0] == "MOLECULE_NAME" and head[-1] == f"FEATURE_{width - 2}"
    # Nine sample rows, the salt, and a second label of a repeated name.
    assert len(rows) == 11
    assert sorted(r[1] for r in rows if r[0] == "w-03") == ["0.75", "9.99"]
    by = {r[0]: [int(x) for x in r[2:]] for r in rows}
    assert [r[0] for r in rows] == sorted((r[0] for r in rows), key=lambda n: n + ".csv")
    if mode == "13C":
        # One value per carbon; the salt has none and keeps an all-zero row.
        assert sum(by["w-04"]) == 8 and sum(by["salt"]) == 0
    if mode == "FP":
        assert set(by["w-04"]) == {0, 1} and sum(by["salt"]) == 0
    errors = spark.read.parquet(str(tmp_path / "errors")).collect()
    assert [(r.name, r.error, r.source, r.mode) for r in errors] == [("bad-1", "unclosed ring", source, mode)]
    stem = out.removesuffix("_ML_input.csv")
    summary = {(r.stage, r.metric): r.value for r in spark.read.parquet(f"{stem}_summary").collect()}
    assert summary["verified", "rows"] == 12 and summary["rejects", "rows"] == 1
    assert spark.read.parquet(f"{stem}_rejects").count() == 1
    assert spark.read.option("header", True).csv(f"{stem}_verified").count() == 12
    if mode != "FP":
        notes = spark.read.parquet(str(tmp_path / "warnings")).collect()
        assert [r.name for r in notes] == ["salt"]


def test_summary_and_checks(spark, source):
    result = build_matrix(spark, source, "FP")
    got = {(r.stage, r.metric): r.value for r in result.summary.collect()}
    assert got == {("verified", "rows"): 12, ("rejects", "rows"): 1, ("duplicates", "removed"): 1, ("errors", "rows"): 1, ("nulls", "cells"): 0}
    with pytest.raises(ValueError):
        build_matrix(spark, source, "2D")
    with pytest.raises(ValueError):
        build_matrix(spark, source, "1H")
    with pytest.raises(ValueError):
        build_matrix(spark, source, "FP", label=1)


@pytest.mark.parametrize("mode", ["1H", "hybrid", "FP"])
def test_summary_runs_nothing_again(spark, source, shifts, mode):
    """The counts come with the stages: reading them scans no table, and side tables are plain scans."""
    result = build_matrix(spark, source, mode, shifts=shifts)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.stage, r.metric): r.value for r in result.summary.collect()}
    assert "Relation" not in plan(result.summary)
    tables = {"verified": result.verified, "rejects": result.rejects, "errors": result.errors, "warnings": result.warnings}
    for name, table in tables.items():
        if table is not None:
            assert got[name, "rows"] == table.count()
            assert not any(word in plan(table) for word in ("Join", "Aggregate", "csv", "Generate"))
    if mode != "FP":
        assert got["dropped", "without_answer"] == sum(r["values"] for r in result.dropped.collect() if r.reason == "without answer")


def test_a_repeated_run_replaces_its_errors(spark, source, tmp_path):
    for label in (3, 3):
        run_mode(spark, source, "FP", str(tmp_path), label, write_mode="overwrite")
    assert [r.name for r in spark.read.parquet(str(tmp_path / "errors")).collect()] == ["bad-1"]
    clean = put(tmp_path, "n;s;l\na;CCO;1,0\n")
    run_mode(spark, clean, "FP", str(tmp_path), write_mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "errors")).count() == 1


def test_text_labels_reach_the_matrix(spark, tmp_path):
    path = put(tmp_path, "n,s,l\na,CCO,active\nb,CCC,inactive\na,CCO,active\n")
    rows = build_matrix(spark, path, "FP").matrix.collect()
    assert sorted((r.name, r.label) for r in rows) == [("a", "active"), ("a", "active"), ("b", "inactive")]
    first = build_matrix(spark, path, "FP", labels_mode="first").matrix.collect()
    assert sorted((r.name, r.label) for r in first) == [("a", "active"), ("b", "inactive")]


def test_conditions_of_the_table_must_be_pinned(spark):
    from featureloom import predict_backoff

    train = spark.createDataFrame([("x", "p", 1.0), ("x", "q", 2.0)], "a string, c string, v double")
    table = fit_backoff(train, [["a"]], "v", conditions=["c"])
    rows = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="conditions"):
        predict_backoff(rows, table, [["a"]])
    assert [r.predicted for r in predict_backoff(rows, table, [["a"]], conditions={"c": "q"}).collect()] == [2.0]


def test_merged_tables_answer_like_one(spark):
    from featureloom import merge_backoff, predict_backoff

    rows = [(a, c, v) for a in "xyz" for c in "pq" for v in ("0.10", "0.20", "0.30", None)] + [("x", "p", "9.99")]
    rows = spark.createDataFrame(rows, "a string, c string, v string").selectExpr("a", "c", "cast(v AS decimal(12,2)) AS v")
    fit = lambda df: fit_backoff(df, [["a"]], "v", conditions=["c"], mergeable=True)
    parts = [fit(rows.filter(f)) for f in ("v < 0.2", "v = 0.2", "v > 0.2 AND a = 'x'", "v > 0.2 AND a <> 'x'", "false")]
    merged = merge_backoff(merge_backoff(*parts[:2]), *parts[2:])
    assert sorted(map(tuple, merged.select(fit(rows).columns).collect())) == sorted(map(tuple, fit(rows).collect()))
    one = spark.createDataFrame([("x",)], "a string")
    assert predict_backoff(one, merged, [["a"]], conditions={"c": "p"}).first().support == 4
    with pytest.raises(ValueError, match="mergeable"):
        merge_backoff(fit_backoff(rows, [["a"]], "v"))


def test_fingerprint_mode_with_branches(spark, tmp_path):
    """Two molecules with the same paths and other branches, and one that is none."""
    path = tmp_path / "in.csv"
    path.write_text("N,S,L\na,CC(C)(C)C,1\nb,C(C)(C)(C)C,2\nc,CC(C)CC,3\nd,C1,4\n")
    result = build_matrix(spark, str(path), "FP", branched=True)
    rows = {r.name: tuple(r.features) for r in result.matrix.collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"] == rows["b"] != rows["c"]
    assert [r.name for r in result.errors.collect()] == ["d"]


@pytest.mark.parametrize("mode", ["13C", "hybrid"])
def test_a_notation_is_worked_on_once_for_its_names(spark, shifts, tmp_path, monkeypatch, mode):
    """Names of one notation, more than a group holds, share one graph; each has its own rows, errors and warnings."""
    from featureloom.operators import graph
    from featureloom.plans import modes

    notations = ["CCO", "C1CC", "[Na+].[Cl-]", "c1ccccc1O"]
    rows = [f"m{i:03},{notations[i % 4]},{i}" for i in range(80)] + ["m000,CCC,-1", "m000,CCO,0"]
    path = put(tmp_path, "n,s,l\n" + "\n".join(rows) + "\n")
    seen, parse, group = [], modes.notation_to_graph, graph.alike
    monkeypatch.setattr(modes, "notation_to_graph", lambda df, *a, **b: seen.append(df.count()) or parse(df, *a, **b))
    monkeypatch.setattr(modes, "alike", lambda *a, **b: group(*a, **b, size=7))
    out = run_mode(spark, path, mode, str(tmp_path / "out"), shifts=shifts, fmt="parquet")
    assert seen == [4]
    got = spark.read.parquet(out).collect()
    names = [f"m{i:03}" for i in range(80) if i % 4 != 1]
    # A label that a name has twice counts once for each pair in the fused matrix.
    copies = 4 if mode == "hybrid" else 2
    assert sorted((r.name, r.label) for r in got) == sorted([(n, float(n[1:])) for n in names] + [("m000", -1.0)] + [("m000", 0.0)] * (copies - 1))
    by = {r.name: tuple(r.features) for r in got}
    assert len({by[n] for n in names}) == 3 and all(by[f"m{i:03}"] == by[f"m{i % 4:03}"] for i in range(80) if i % 4 != 1)
    log = lambda name: sorted(r.name for r in spark.read.parquet(str(tmp_path / "out" / name)).collect())
    assert log("errors") == [n for n in (f"m{i:03}" for i in range(80)) if int(n[1:]) % 4 == 1]
    assert log("warnings") == [n for n in names if int(n[1:]) % 4 == 2]


def test_rows_are_sorted_before_vectors_are_dense(spark, shifts, tmp_path, monkeypatch):
    """The sort moves the few buckets of a row that are not empty, not the vector."""
    from featureloom.sinks import tables

    plans, write = [], tables._write
    monkeypatch.setattr(tables, "_write", lambda df, *a: plans.append(df._jdf.queryExecution().analyzed().toString()) or write(df, *a))
    path = put(tmp_path, "n,s,l\nb,CCO,1\na,CCC,2\n")
    run_mode(spark, path, "1H", str(tmp_path / "out"), shifts=shifts, fmt="parquet")
    assert "entries" in plans[0].split("Sort [")[1].split("\n")[1] and "features" not in plans[0].split("Sort [")[1]
    kept = build_matrix(spark, path, "1H", shifts=shifts, keep_unlabelled=True).matrix.collect()
    assert sorted((r.name, r.label, len(r.features)) for r in kept) == [("a", 2.0, 200), ("b", 1.0, 200)]


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)"])
def test_a_weighted_fit_is_that_of_the_repeated_rows(spark, kind):
    rows = spark.createDataFrame([("x", "a", 1.25, 3), ("x", "b", 2.5, 2), ("y", "a", 4.0, 1), ("y", "b", None, 5)], "p string, q string, v double, n int")
    rows = rows.withColumn("v", F.col("v").cast(kind))
    each = rows.withColumn("i", F.explode(F.sequence(F.lit(1), "n")))
    fit = lambda df, **b: sorted(map(tuple, fit_backoff(df, [["p"], ["p", "q"]], "v", mergeable=True, **b).collect()))
    assert fit(rows, weight="n") == fit(each)
