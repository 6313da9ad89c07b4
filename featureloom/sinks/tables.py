"""Writers. Wide columns exist only here; everything upstream keeps vectors as arrays."""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.assembly import expand_copies, name_features, order_like_files
from ..operators.histogram import chunks, vector_long


def _stem(path: str) -> str:
    return posixpath.basename(path.rstrip("/")).rsplit(".", 1)[0]


def verified_path(source: str) -> str:
    """``<in>_verified.csv`` next to the input."""
    folder = posixpath.dirname(source.rstrip("/"))
    return posixpath.join(folder, f"{_stem(source)}_verified.csv")


def matrix_path(folder: str, source: str, mode: str) -> str:
    """``<folder>/<base>_<mode>_ML_input.csv`` for the input or its verified copy."""
    base = _stem(source).removesuffix("_verified")
    return posixpath.join(folder, f"{base}_{mode}_ML_input.csv")


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> str:
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"format must be 'csv' or 'parquet', not {fmt!r}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)
    return path


def write_verified(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> str:
    """The verified table, without the order column where the format is flat."""
    return _write(df.drop("ord") if fmt == "csv" else df, path, fmt, mode)


def write_matrix(
    df: DataFrame, path: str, n: int, fmt: str = "csv", ordered: bool = False,
    mode: str = "errorifexists", key: str = "name", finish: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """``MOLECULE_NAME, LABEL, FEATURE_1..n`` as csv, or the array form as parquet.

    Rows counted in ``copies`` are written out. ``ordered`` sorts by file name order. ``finish`` makes the vectors of
    compact rows, after they are sorted.
    """
    rows = expand_copies(df) if "copies" in df.columns else df
    if ordered:
        rows = order_like_files(rows, key)
    rows = rows if finish is None else finish(rows)
    return _write(name_features(rows, n, key) if fmt == "csv" else rows, path, fmt, mode)


def write_vectors(df: DataFrame, path: str, key: str = "name", mode: str = "errorifexists") -> str:
    """Vectors as one long table ``(key, pos, value)``; never a file per row.

    Rows that are long already (see :func:`long_positions`) are written as they are.
    """
    long = df if {"pos", "value"} <= set(df.columns) else vector_long(df, key)
    return _write(long.select(key, "pos", "value"), path, "parquet", mode)


def write_chunks(df: DataFrame, path: str, key: str = "name", length: int = 1024, mode: str = "errorifexists") -> str:
    """Vectors as rows ``(key, start, values)`` of at most ``length`` values, whatever their length.

    ``df`` is long (``key``, ``pos``, ``value``, positions without gaps, see :func:`long_positions`) or has vectors. A chunk, not a
    vector, is what a task gathers, so the chunks of a vector that holds a third of all values lie in many tasks. A null
    value keeps its place; an empty vector has no row.
    """
    return _write(chunks(df if {"pos", "value"} <= set(df.columns) else vector_long(df, key), key, length), path, "parquet", mode)


def append_log(df: DataFrame, path: str, **origin: str) -> str:
    """Write rows into the table of errors or warnings at ``path``.

    ``origin`` adds constant columns, such as the source and the mode of a run, so that the rows
    of several runs in one table can be told apart. Rows of one origin have a partition ``run`` of their own: a run that
    is repeated replaces what it wrote before, also by nothing. Without an origin rows are appended.
    """
    flat = df.select(*[
        F.concat_ws(", ", f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else f.name
        for f in df.schema.fields
    ], *[F.lit(value).alias(name) for name, value in origin.items()])
    if not origin:
        return _write(flat, path, "parquet", "append")
    run = hashlib.sha256(repr(sorted(origin.items())).encode()).hexdigest()[:16]
    _write(flat, f"{path.rstrip('/')}/run=r{run}", "parquet", "overwrite")
    return path
