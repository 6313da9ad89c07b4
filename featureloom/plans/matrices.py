"""The named modes: verified table, spectral matrix, fingerprint matrix, fused matrix."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import bucket_index, preset
from ..functions.cells import fix_decimal_comma, format_shift, named, to_double
from ..functions.vectors import words_to_vector
from ..operators.assembly import attach_labels, fuse, label_column
from ..operators.backoff import predict_backoff
from ..operators.cleaning import (
    clean_keys, drop_incomplete, drop_null_features, fix_decimal_commas, null_tokens, take_columns,
)
from ..operators.graph import label_signature
from ..operators.histogram import bucketize, entries, sparse_histogram
from ..operators.quality import dedup_keep_first
from ..sources.delimited import detect_delimiter, read_delimited, split_malformed
from ..sources.dialects import file_dialects, read_dialects


@dataclass
class Verified:
    """Tables of the verification step."""

    rows: DataFrame       # name, notation, label, ord
    rejects: DataFrame    # malformed records
    nulls: DataFrame      # nulls per column before incomplete rows are dropped
    separator: str


def verify_table(
    spark: SparkSession, path: str, label: int = 3, short_rows: str = "pad",
    multi_line: bool | str = False, label_kind: str = "auto", watch: Observation | None = None,
    dialects: bool = False,
) -> Verified:
    """Read, repair and clean a delimited table of name, notation and label.

    Labels may be numbers or words. ``label_kind`` is ``number``, ``text`` or ``auto``: numbers if every
    label is one, which takes a look at all labels. ``watch`` counts the nulls of each column, under its position,
    while the rows are read. With ``dialects`` every file has its own separator and order of columns
    (:func:`read_dialects`); decimal commas are repaired in files of semicolons, and ``separator`` names all that occur.
    """
    if label_kind not in ("auto", "number", "text"):
        raise ValueError(f"label_kind must be 'auto', 'number' or 'text', not {label_kind!r}")
    if dialects and multi_line:
        raise ValueError("files of several dialects are read line by line")
    if dialects:
        sep = "".join(sorted(r.sep for r in file_dialects(spark, path).select("sep").distinct().collect()))
        good, rejects = read_dialects(spark, path, short_rows=short_rows)
        data = take_columns(good.drop("ord", "sep"), 3).columns
        table = null_tokens(good.select(*map(named, data), "ord", "sep"), data)
        fixed = [F.when(F.col("sep") == ";", fix_decimal_comma(named(c))).otherwise(named(c)).alias(c) for c in data]
        table = table.select(*fixed, "ord")
    else:
        sep = detect_delimiter(spark, path)
        raw = read_delimited(spark, path, sep, multi_line=multi_line)
        good, rejects = split_malformed(raw, sep, short_rows)
        data = take_columns(good.drop("ord"), 3).columns
        table = null_tokens(good.select(*map(named, data), "ord"))
        if sep == ";":
            table = fix_decimal_commas(table, data)
    table = clean_keys(table, data[0])
    target = label_column(take_columns(table, len(data)), label)
    full, nulls = drop_incomplete(table)
    watched = full
    if watch is not None:
        counts = [F.count_if(named(c).isNull()).alias(str(i)) for i, c in enumerate(data)]
        watched, _ = drop_incomplete(table.observe(watch, *counts))
    value = to_double(named(target))
    if label_kind == "auto":
        label_kind = "number" if full.filter(value.isNull()).isEmpty() else "text"
    rows = watched.select(
        named(data[0]).alias("name"), named(data[1]).alias("notation"),
        (value if label_kind == "number" else named(target)).alias("label"), "ord",
    )
    return Verified(rows, rejects, nulls.filter("column <> 'ord'"), sep)


def distinct_records(verified: DataFrame) -> DataFrame:
    """First record of every name, in input order."""
    return dedup_keep_first(verified, ["name"], ["ord"])


def answer_nodes(
    signatures: DataFrame, table: DataFrame, radius: int = 2, target: str | None = None,
    min_support: int = 1, conditions: dict[str, str] | None = None, digits: int = 2,
) -> DataFrame:
    """``(name, value)`` of every node labelled ``target``; the value is null where no level knows the node.

    ``signatures`` comes from :func:`circular_signatures` over the whole graphs and serves
    several targets. The label is recognised by its own hash ``sig_0``, so no join with the
    nodes is needed.
    """
    wanted = signatures
    if target is not None:
        wanted = signatures.filter(F.col("sig_0") == label_signature(target))
    answered = predict_backoff(wanted, table, signature_levels(radius), min_support, conditions)
    return answered.select(F.col("graph_id").alias("name"), format_shift("predicted", digits).alias("value"))


def unanswered(
    signatures: DataFrame, table: DataFrame, radius: int = 2, target: str | None = None,
    min_support: int = 1, conditions: dict[str, str] | None = None,
) -> DataFrame:
    """``(name, nodes)``: nodes labelled ``target`` that no level of the table knows, counted by name."""
    answered = answer_nodes(signatures, table, radius, target, min_support, conditions)
    return answered.filter("value IS NULL").groupBy("name").agg(F.count(F.lit(1)).alias("nodes"))


def predict_values(
    signatures: DataFrame, table: DataFrame, radius: int = 2, target: str | None = None,
    min_support: int = 1, conditions: dict[str, str] | None = None, digits: int = 2,
) -> DataFrame:
    """``(name, value)`` of the nodes labelled ``target`` that have an answer, looked up by their surroundings."""
    return answer_nodes(signatures, table, radius, target, min_support, conditions, digits).filter("value IS NOT NULL")


def dropped_values(answered: DataFrame, axis: str) -> DataFrame:
    """``(mode, name, reason, values)`` of one spectral mode: answers outside its axis and nodes without one, counted in one pass."""
    lo, hi, n = preset(axis)
    outside = F.col("value").isNotNull() & bucket_index("value", lo, hi, n).isNull()
    counts = answered.groupBy("name").agg(F.count_if(outside).alias("outside"), F.count_if(F.col("value").isNull()).alias("unknown"))
    both = F.array(
        F.struct(F.lit("outside axis").alias("reason"), F.col("outside").alias("values")),
        F.struct(F.lit("without answer").alias("reason"), F.col("unknown").alias("values")),
    )
    return counts.select(F.lit(axis).alias("mode"), "name", F.inline(both)).filter("values > 0")


def signature_levels(radius: int) -> list[list[str]]:
    """Levels for the reference table, coarsest first."""
    return [[f"sig_{i}"] for i in range(radius + 1)]


def spectral_vectors(
    values: DataFrame, names: DataFrame, axis: str | tuple[float, float, int],
) -> DataFrame:
    """``(name, features)``; every name has a vector, all zero if it has no value."""
    lo, hi, n = preset(axis) if isinstance(axis, str) else axis
    return bucketize(values, "name", "value", lo, hi, n, keys=names.select("name"))


def spectral_entries(values: dict[str, DataFrame], names: DataFrame) -> DataFrame:
    """``(name, entries)``: the vectors of the spectral modes in ``values`` one behind the other, see :func:`entries`."""
    offset, tables = 0, []
    for mode, table in values.items():
        lo, hi, n = preset(mode)
        tables.append(sparse_histogram(table, "name", "value", lo, hi, n, keys=names.select("name")).withColumn("bucket", F.col("bucket") + offset))
        offset += n
    return entries(reduce(DataFrame.unionByName, tables), "name")


def spectral_matrix(
    values: DataFrame, names: DataFrame, labels: DataFrame,
    axis: str | tuple[float, float, int], *, label: str = "label",
    labels_mode: str = "all", order: list[str] | None = None, keep_unlabelled: bool = False,
) -> DataFrame:
    """``(name, label, features)`` of one spectral mode."""
    vectors = spectral_vectors(values, names, axis)
    matrix = attach_labels(
        vectors, labels, "name", label, labels_mode=labels_mode, order=order,
        keep_unlabelled=keep_unlabelled, keys=names,
    )
    n = (preset(axis) if isinstance(axis, str) else axis)[2]
    return matrix if keep_unlabelled else drop_null_features(matrix, n)


def fingerprint_matrix(
    words: DataFrame, labels: DataFrame, n_bits: int = 2048, *, key: str = "graph_id",
    label: str = "label", labels_mode: str = "all", order: list[str] | None = None,
    keep_unlabelled: bool = False, keys: DataFrame | None = None,
) -> DataFrame:
    """``(name, label, features)`` of the fingerprint mode.

    ``words`` is any fingerprint made with ``dense=False``. Labels are joined to the compact
    words; the dense vector is built last. ``keys`` is a cheaper table of the names, if there is one.
    """
    joined = attach_labels(
        words.withColumnRenamed(key, "name"), labels, "name", label, labels_mode=labels_mode,
        order=order, keep_unlabelled=keep_unlabelled, keys=keys,
    )
    return joined.select("name", "label", words_to_vector("words", n_bits).alias("features"))


def hybrid_matrix(
    first: DataFrame, second: DataFrame, labels: DataFrame, *, label: str = "label",
    keep_unlabelled: bool = False, keys: DataFrame | None = None, labels_mode: str = "all",
    order: list[str] | None = None,
) -> DataFrame:
    """``(name, label, features, copies)`` from the vectors ``(name, features)`` of two modes.

    Joining the two labelled matrices gives ``k * k`` equal rows for a label that occurs
    ``k`` times under a name. The same multiset comes from joining the vectors once by name
    and counting each label, with ``copies = k * k``.
    """
    fused = fuse(first, second, on=["name"], unique=True).drop("copies")
    return count_labels(fused, labels, label=label, keep_unlabelled=keep_unlabelled, keys=keys, labels_mode=labels_mode, order=order)


def count_labels(
    fused: DataFrame, labels: DataFrame, *, label: str = "label", keep_unlabelled: bool = False, keys: DataFrame | None = None,
    labels_mode: str = "all", order: list[str] | None = None,
) -> DataFrame:
    """``(name, label, …rest of fused, copies)`` of fused vectors, each label of a name once with its ``copies``."""
    if labels_mode == "first":
        if not order:
            raise ValueError("labels_mode='first' needs the order columns")
        labels = dedup_keep_first(labels.select("name", label, *order), ["name"], order)
    counted = labels.groupBy("name", F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("k")
    )
    if not keep_unlabelled:
        counted = counted.filter("label IS NOT NULL")
    # Names without any label row behave like one null label on both sides.
    joined = attach_labels(
        fused, counted.select("name", F.struct("label", "k").alias("__l")), "name", "__l",
        keep_unlabelled=keep_unlabelled, keys=keys,
    )
    one = F.lit(1).cast("bigint")
    return joined.select(
        "name",
        F.col("label")["label"].alias("label"),
        *[c for c in fused.columns if c != "name"],
        F.coalesce(F.col("label")["k"] * F.col("label")["k"], one).alias("copies"),
    )
