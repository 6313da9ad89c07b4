"""One call per mode: delimited file in, labelled matrix and side tables out."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import preset
from ..functions.vectors import dense_from_sorted
from ..operators.assembly import attach_labels
from ..operators.graph import alike, circular_signatures, expand_implicit, kind_members, notation_kinds, notation_to_graph
from ..operators.quality import graph_metrics, graph_rules, observed, observed_summary, route, warnings
from ..operators.rowgraphs import notation_paths
from ..operators.subgraphs import notation_branched_fingerprint
from ..session import dealt, spread, stage
from ..sinks.tables import append_log, matrix_path, write_matrix, write_verified
from .matrices import (
    answer_nodes, count_labels, distinct_records, dropped_values, fingerprint_matrix, spectral_entries, verify_table,
)

# The element whose atoms give the values of a spectral mode.
TARGETS = {"1H": "H", "13C": "C"}
MODES = (*TARGETS, "FP", "hybrid")


@dataclass
class ModeResult:
    """Everything a run produces; all tables are lazy except where a result is staged."""

    matrix: DataFrame                  # name, label, features (hybrid: copies as well)
    width: int
    rejects: DataFrame                 # malformed records
    errors: DataFrame                  # name, notation, error
    warnings: DataFrame | None         # name, warning (graph modes only)
    summary: DataFrame = field(repr=False, default=None)
    verified: DataFrame = field(repr=False, default=None)  # name, notation, label, ord
    dropped: DataFrame = field(repr=False, default=None)   # mode, name, reason, values
    compact: DataFrame = field(repr=False, default=None)   # the matrix with its vectors as entries (spectral modes only)


def build_matrix(
    spark: SparkSession, path: str, mode: str, label: int = 3, *,
    shifts: dict[str, DataFrame] | None = None, radius: int = 2, min_support: int = 1,
    conditions: dict[str, str] | None = None, n_bits: int = 2048, short_rows: str = "pad",
    keep_unlabelled: bool = False, labels_mode: str = "all", label_kind: str = "auto",
    multi_line: bool | str = False, branched: bool = False, dialects: bool = False,
) -> ModeResult:
    """Run one of the modes ``1H``, ``13C``, ``FP`` and ``hybrid`` on a delimited file.

    ``label`` is the 1-based label column; its labels are numbers or words. The spectral modes need ``shifts``: per mode the
    reference table of :func:`fit_backoff` over :func:`signature_levels` of typed signatures. ``branched`` makes the mode ``FP`` of all
    connected sets of 1 to 7 bonds instead of the unbranched paths among them. With ``dialects`` the files of a folder have their own
    separators and orders of columns.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spectral = [m for m in TARGETS if mode in (m, "hybrid")]
    lacking = [m for m in spectral if m not in (shifts or {})]
    if lacking:
        raise ValueError(f"mode {mode!r} needs reference tables for {lacking}")

    count = F.count(F.lit(1))
    nulls = Observation("nulls")
    verified = verify_table(spark, path, label, short_rows, multi_line, label_kind, nulls, dialects)
    rows, seen = observed(verified.rows, "verified", {"rows": count})
    rejects, rejected = observed(verified.rejects, "rejects", {"rows": count})
    first, kept = observed(distinct_records(rows), "records", {"rows": count})
    records = spread(first)
    labels = rows.select("name", "label", "ord")
    choice = {"labels_mode": labels_mode, "order": ["ord"], "keep_unlabelled": keep_unlabelled}
    notes = dropped = compact = None
    found = {}
    if mode == "FP":
        if branched:
            words, errors = notation_branched_fingerprint(records, "name", "notation", n_bits=n_bits, dense=False)
        else:
            words, errors = notation_paths(records, "name", "notation", n_bits=n_bits, dense=False)
        errors, failed = observed(errors, "errors", {"rows": count})
        valid = records.select("name").join(dealt(errors.select("name")), "name", "left_anti")
        matrix = fingerprint_matrix(words, labels, n_bits, keys=valid, **choice)
        width = n_bits
    else:
        # What follows from a notation alone is found once for it and handed to the names that have it.
        groups, _ = alike(first, "name", "notation", unique=True)
        kinds, homes = notation_kinds(groups)
        handed = lambda found: kind_members(found, homes, groups).withColumnRenamed("graph_id", "name")
        nodes, edges, bad = notation_to_graph(spread(kinds), "graph_id", "notation")
        errors, failed = observed(handed(bad.withColumnRenamed("name", "graph_id")), "errors", {"rows": count})
        valid = stage(nodes.filter("node_id = 0").select(F.col("graph_id").alias("name")), "names")
        metrics = graph_metrics(nodes, edges).join(dealt(kinds), "graph_id")
        _, routed = route(graph_rules(metrics, F.col("notation").contains(".")))
        notes, warned = observed(warnings(handed(routed.select("graph_id", "reasons")), "name"), "warnings", {"rows": count})
        # Every round of the signatures reads both tables: they are expanded once, not once for each use.
        nodes, edges = (stage(t, "expanded") for t in expand_implicit(nodes, edges))
        signatures = stage(circular_signatures(nodes, edges, radius, typed=True), "signatures")
        # Answers are looked up once: they serve the vectors and the report of what is left out.
        answers = {
            m: stage(answer_nodes(signatures, shifts[m], radius, TARGETS[m], min_support, conditions), "answers")
            for m in spectral
        }
        of = lambda reason: F.sum(F.when(F.col("reason") == reason, F.col("values")))
        missing = reduce(DataFrame.unionByName, [dropped_values(answers[m], m) for m in spectral])
        dropped, missed = observed(
            handed(missing.withColumnRenamed("name", "graph_id")).select("mode", "name", "reason", "values"), "dropped",
            {"outside_axis": of("outside axis"), "without_answer": of("without answer")},
        )
        found = {"warnings": warned.get, "dropped": missed.get}
        width = sum(preset(m)[2] for m in spectral)
        vectors = spectral_entries({m: answers[m].filter("value IS NOT NULL") for m in spectral}, valid)
        vectors = handed(stage(vectors.withColumnRenamed("name", "graph_id"), "vectors"))
        if keep_unlabelled:
            choice["keys"] = handed(valid.withColumnRenamed("name", "graph_id"))
        if mode == "hybrid":
            compact = count_labels(vectors, labels, **choice)
        else:
            compact = attach_labels(vectors, labels, "name", "label", **choice)
        matrix = _dense(compact, width)
    found = {
        "verified": seen.get, "rejects": rejected.get, "duplicates": {"removed": seen.get["rows"] - kept.get["rows"]},
        "errors": failed.get, "nulls": {"cells": sum(nulls.get.values())}, **found,
    }
    return ModeResult(matrix, width, rejects, errors, notes, observed_summary(spark, found), rows, dropped, compact)


def _dense(compact: DataFrame, width: int) -> DataFrame:
    """Rows with the ``features`` that their ``entries`` stand for."""
    return compact.select(*[dense_from_sorted("entries", width).alias("features") if c == "entries" else c for c in compact.columns])


def run_mode(
    spark: SparkSession, path: str, mode: str, folder: str, label: int = 3, *,
    ordered: bool = True, fmt: str = "csv", write_mode: str = "errorifexists", **options,
) -> str:
    """Build a matrix and write it with its side tables below ``folder``.

    ``<base>_<mode>_verified``, ``…_rejects``, ``…_dropped`` and ``…_summary`` belong to one run;
    ``errors`` and ``warnings`` collect those of all runs, with their source and mode.
    """
    result = build_matrix(spark, path, mode, label, **options)
    tag = "HYBRID" if mode == "hybrid" else mode
    # Rows are sorted before their vectors are made dense.
    rows, finish = (result.matrix, None) if result.compact is None else (result.compact, lambda df: _dense(df, result.width))
    out = write_matrix(rows, matrix_path(folder, path, tag), result.width, fmt, ordered, write_mode, finish=finish)
    stem = out.removesuffix("_ML_input.csv")
    write_verified(result.verified, f"{stem}_verified", fmt, write_mode)
    for name, rows in (("rejects", result.rejects), ("dropped", result.dropped), ("summary", result.summary)):
        if rows is not None:
            rows.write.mode(write_mode).parquet(f"{stem}_{name}")
    folder = folder.rstrip("/")
    append_log(result.errors, f"{folder}/errors", source=path, mode=mode)
    if result.warnings is not None:
        append_log(result.warnings, f"{folder}/warnings", source=path, mode=mode)
    return out
