"""Centroid clustering of integer vectors over a VA-file.

Every vector is written twice into one table: as cells, one of ``2 ** bits`` equal intervals of its
dimension, and as whole integers. A round turns the centroids into lookup tables, for each
dimension and cell the least and the largest share that a centroid's squared distance can have. Their sums
over the dimensions bound the distance of a vector to each centroid, less the part that is
the same for all of them (the squared distance of the vector from the middle of the table). Where the least
of these intervals meets no other one the cells decide; only the other rows, and those that change their cluster,
hand their integers to a worker. Sums of the clusters are kept from round to round and corrected by
the rows that moved. All arithmetic is on integers, so intervals are never too narrow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import LAST, staged

BITS = 8
# Squares of twice this, over some hundred dimensions, still fit a long.
LARGEST = 1 << 26


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``(vec_id, v)``: ``floor(scale * x)`` of the vectors with ``dims`` finite components, none null.

    Vectors with a scaled component of :data:`LARGEST` or more take no part: their squared distances would not
    fit a long.
    """
    bound = F.lit(float(LARGEST) / scale)
    small = lambda x: F.abs(x.cast("double")) < bound  # noqa: E731  false for NaN and infinities, null for null
    kept = df.where((F.size(vec_col) == dims) & F.forall(vec_col, small))
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("int"))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors whose ``prefix || vec_id`` has the least SHA-256, in that order.

    Equal ids are told apart by their vectors, null ids come last.
    """
    key = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def _total(parts: DataFrame, by: list[str], columns: dict[str, tuple[Callable, int]]) -> DataFrame:
    """Arrays of partial results, folded component by component."""
    return parts.groupBy(*by).agg(*[
        F.array(*[fold(F.col(name)[i]) for i in range(n)]).alias(name) for name, (fold, n) in columns.items()
    ])


def axis_ranges(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Least, largest and middle value of every dimension; none for an empty table."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = high = None
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy())
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pd.DataFrame({"low": [low.tolist()], "high": [high.tolist()]})

    parts = vectors.select("v").mapInPandas(ranges, "low array<long>, high array<long>")
    row = _total(parts, [], {"low": (F.min, dims), "high": (F.max, dims)}).first()
    if row.low[0] is None:
        return None
    low, high = np.array(row.low, np.int64), np.array(row.high, np.int64)
    return low, high, (low + high) // 2


def write_cells(vectors: DataFrame, low: np.ndarray, width: np.ndarray) -> DataFrame:
    """The VA-file: ``(vec_id, cells, whole)``, a byte and four bytes for each component."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy()).astype(np.int64)
                cells = ((x - low) // width).astype(np.uint8)
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"], "cells": [c.tobytes() for c in cells], "whole": [w.tobytes() for w in x.astype("<i4")],
                })

    return staged(vectors.mapInPandas(pack, "vec_id long, cells binary, whole binary"), "cells")


class Intervals:
    """Lookup tables of a set of centroids: bounds of the distances from the cells of a vector."""

    def __init__(self, centroids: np.ndarray, low: np.ndarray, width: np.ndarray, middle: np.ndarray, cells: int):
        starts = low + width * np.arange(cells)[:, None] - middle
        c = centroids - middle
        one, two = (c[None] ** 2 - 2 * c[None] * edge[:, None] for edge in (starts, starts + width - 1))
        both = np.concatenate([np.minimum(one, two), np.maximum(one, two)], axis=1)  # cell, bound of a centroid, dimension
        self.tables = np.ascontiguousarray(both.transpose(2, 0, 1))
        self.k = len(centroids)

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For every vector and centroid, whether it may be the nearest one."""
        bounds = np.zeros((len(cells), 2 * self.k), np.int64)
        for d, table in enumerate(self.tables):
            bounds += table[cells[:, d]]
        return bounds[:, : self.k] <= bounds[:, self.k :].min(axis=1)[:, None]


def _bytes(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def _decided(candidates: np.ndarray) -> np.ndarray:
    """The only candidate, -1 where there are several."""
    return np.where(candidates.sum(axis=1) == 1, candidates.argmax(axis=1), -1).astype(np.int32)


def nearest_of(whole: np.ndarray, centroids: np.ndarray, decided: np.ndarray) -> np.ndarray:
    """The nearest centroid (ties: the smaller number); computed only where the cells left it open."""
    out = decided.copy()
    at = np.flatnonzero(decided < 0)
    if len(at):
        x = whole[at]
        out[at] = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1).argmin(axis=1)
    return out


def _by_cells(tables: list[Intervals]) -> Callable[..., Column]:
    """A function of ``cells``: the cluster that each set of centroids gives, -1 where cells leave it open."""
    names = [f"c{i}" for i in range(len(tables))]

    @F.pandas_udf(", ".join(f"{n} int" for n in names))
    def by_cells(cells: pd.Series) -> pd.DataFrame:
        codes = _bytes(cells, np.uint8)
        return pd.DataFrame({n: _decided(t.candidates(codes)) if len(codes) else np.zeros(0, np.int32) for n, t in zip(names, tables)})

    return by_cells


def _moves(centroids: list[np.ndarray], dims: int) -> Callable:
    """Task: changes of the counts and sums of each cluster from the rows that the cells did not settle."""
    k = len(centroids[-1])

    def moves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x = _bytes(batch["whole"], "<i4").astype(np.int64)
            new = nearest_of(x, centroids[-1], batch["c0"].to_numpy())
            old = nearest_of(x, centroids[0], batch["c1"].to_numpy()) if len(centroids) > 1 else np.full(len(x), -1)
            moved = new != old
            for side, sign in ((new, 1), (old, -1)):
                for c in range(k):
                    here = moved & (side == c)
                    count[c] += sign * here.sum()
                    total[c] += sign * x[here].sum(axis=0)
        yield pd.DataFrame({"cluster": np.arange(k), "n": count, "total": total.tolist()})

    return moves


def cluster_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, dims: int = 64, k: int = 8,
    rounds: int = 10, scale: int = 1024, prefix: str = "3:", bits: int = BITS,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector.

    Vectors that are null, of another length, or hold a null, NaN or infinite component take no part, nor do those of
    :func:`integer_vectors` that are too large. Every row counts, also of repeated or null ids. With fewer than ``k``
    vectors there are as many centroids as vectors; an empty table gives no rows. Ties go to the
    smaller cluster number. Other columns are not read. An inertia that does not fit a long is null.

    What is not ours to shorten: the integers of all rows are read in the first round and at the end; in between, those of rows
    that the cells settle stay in the scan.
    """
    spark = df.sparkSession
    if not 1 <= bits <= 8:
        raise ValueError("bits must lie between 1 and 8")
    vectors = integer_vectors(df, id_col, vec_col, dims, scale)
    ranges = axis_ranges(vectors, dims)
    if ranges is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    low, high, middle = ranges
    width = (high - low) // (1 << bits) + 1
    file = write_cells(vectors, low, width)
    now, before = first_centroids(vectors, k, prefix), None
    count, total = [0] * len(now), [[0] * dims for _ in now]
    tables = lambda c: Intervals(c, low, width, middle, 1 << bits)
    for _ in range(rounds):
        sets = [now] if before is None else [before, now]
        told = file.select("whole", _by_cells([tables(c) for c in reversed(sets)])("cells").alias("at"))
        if before is None:
            told = told.select("whole", "at.c0")
        else:
            told = told.select("whole", "at.*").where("c0 < 0 or c1 < 0 or c0 <> c1")
        parts = told.mapInPandas(_moves(sets, dims), "cluster int, n long, total array<long>")
        sums = _total(parts.withColumn("n", F.array("n")), ["cluster"], {"n": (F.sum, 1), "total": (F.sum, dims)})
        for row in sums.collect():
            count[row.cluster] += row.n[0]
            total[row.cluster] = [a + b for a, b in zip(total[row.cluster], row.total)]
        after = np.array([[s // n for s in t] if n else c.tolist() for n, t, c in zip(count, total, now)], np.int64)
        if before is not None and (after == now).all():
            break  # nothing will change any more
        before, now = now, after
    last = tables(now)

    @F.pandas_udf("cluster int, distance long")
    def place(cells: pd.Series, whole: pd.Series) -> pd.DataFrame:
        x = _bytes(whole, "<i4").astype(np.int64)
        if not len(x):
            return pd.DataFrame({"cluster": np.zeros(0, np.int32), "distance": np.zeros(0, np.int64)})
        at = nearest_of(x, now, _decided(last.candidates(_bytes(cells, np.uint8))))
        return pd.DataFrame({"cluster": at, "distance": ((x - now[at]) ** 2).sum(axis=1)})

    placed = staged(file.select("vec_id", place("cells", "whole").alias("at")).select("vec_id", "at.*"), "clusters")
    sums = {r.cluster: int(r.t) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("t")).collect()}
    fitting = lambda n: n if n <= LAST else None
    report = [  # one row for each of the k clusters
        (i, fitting(sums.get(i, 0)), fitting(sum(sums.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(now.tolist())
    ]
    report = spark.createDataFrame(report, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(report), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
