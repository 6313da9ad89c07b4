"""Nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one more component that makes all their norms equal, so that the largest inner product
is the least distance on a sphere. A random rotation spreads every distance evenly over the
columns. Vectors are held in lists around centroids; a query probes the nearest lists. Within a
list the columns are read in blocks: from the partial distance of a candidate a hypothesis test
tells whether its whole distance can still beat the best found, and others are dropped. Survivors
are scored exactly, in double precision on the original vectors.

Short lists share a bin, long ones are cut into shards, and the queries of a bin are cut into blocks;
every shard of a bin meets every block in a group of bounded size, whatever share of the vectors
one list holds. The nearest lists are scanned first; the distance of a query's last hit there bounds
what the other lists return.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureloom.llm.shared import hash_share, staged

SHARD, QUERIES = 8192, 2048
COLUMNS = 16
EPSILON = 2.1


@dataclass
class ListIndex:
    """Rotation, centroids and the least and most that a query probes."""

    rotation: np.ndarray
    centroids: np.ndarray
    longest: float  # the largest squared norm

    def points(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit points on the sphere, rotated."""
        norm = (x * x).sum(axis=1)
        if query:
            y = np.column_stack([x / np.sqrt(norm)[:, None], np.zeros(len(x))])
        else:
            y = np.column_stack([x, np.sqrt(np.maximum(self.longest - norm, 0))]) / np.sqrt(self.longest)
        return y @ self.rotation


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(i, v)`` of the vectors that take part, one for each id, and their dimension.

    Null ids, null or zero vectors and such with null or non-finite components take no part, nor do
    those of another than the most frequent dimension. Of repeated ids the least vector does.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("i"), v.alias("v")).where(F.col("i").isNotNull() & F.coalesce(good, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = sizes["d"] if sizes else 0
    return rows.where(F.size("v") == dim).groupBy("i").agg(F.min("v").alias("v")), dim


def fit_lists(rows: DataFrame, dim: int, lists: int | None = None, sample: int = 32_768, rounds: int = 8, seed: int = 5) -> tuple[ListIndex, int]:
    """Centroids by spherical k-means on a hashed sample of at most about ``sample`` vectors (the bound of the fit)."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    stats = rows.agg(F.count("*").alias("n"), F.max(norm).alias("most")).first()
    n = stats["n"]
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))[0]
    index = ListIndex(rotation, np.zeros((0, dim + 1)), stats["most"] or 1.0)
    if not n:
        return index, 0
    k = lists or int(min(4096, max(1, round(2 * n**0.5))))
    drawn = rows.where(hash_share(n, sample, "i")).orderBy("i").limit(2 * sample).toPandas()
    x = index.points(np.stack(drawn["v"]) if len(drawn) else np.eye(dim), query=False)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(x[lo : lo + 4096] @ c.T).argmax(axis=1) for lo in range(0, len(x), 4096)])
        size = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(size[:, None] > 0, total, c)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    index.centroids = c
    return index, n


PAIRS = 1 << 20


def scan_list(
    x: np.ndarray, y: np.ndarray, ids: np.ndarray, q: np.ndarray, p: np.ndarray, own: np.ndarray, bound: np.ndarray, top: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(query number, candidate number, score)`` of the best ``top`` of a list for each of some queries.

    ``x``, ``q``: original vectors; ``y``, ``p``: their points; ``own``: the queries' ids; ``bound``: the squared
    distance that a candidate must not exceed.
    """
    width, n = y.shape[1], len(y)
    for lo in range(0, len(q), max(1, PAIRS // n)):
        some = slice(lo, lo + max(1, PAIRS // n))
        pc, limit = p[some], bound[some].copy()
        if n > top + 1:  # the first candidates alone give a bound too; one may be the query itself
            first = y[: 2 * top + 2]
            exact = np.maximum(2 - 2 * pc @ first.T, 0)
            exact[own[some][:, None] == ids[: 2 * top + 2]] = np.inf
            limit = np.minimum(limit, np.partition(exact, top - 1, axis=1)[:, top - 1])
        partial = np.zeros((len(pc), n))
        keep = ids != own[some][:, None]
        pairs = None
        for c in range(0, width, COLUMNS):
            block = slice(c, c + COLUMNS)
            seen = min(width, c + COLUMNS)
            slack = (1 + EPSILON / seen**0.5) ** 2 * seen / width if seen < width else 1 + 1e-9
            if pairs is None:
                a, b = pc[:, block], y[:, block]
                partial += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
                keep &= partial <= (limit * slack)[:, None]
                if seen == width or keep.mean() < 0.2:
                    pairs = np.nonzero(keep)
                    partial = partial[pairs]
            else:
                i, j = pairs
                partial = partial + ((pc[i, block] - y[j, block]) ** 2).sum(axis=1)
                good = partial <= limit[i] * slack
                pairs, partial = (i[good], j[good]), partial[good]
        i, j = pairs
        score = np.einsum("ij,ij->i", q[lo + i], x[j])
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        start = np.searchsorted(i, i)
        best = np.arange(len(i)) - start < top
        yield lo + i[best], j[best], score[best]


def nearest(
    vectors: DataFrame, is_query: Callable[[Column], Column], top: int = 20, share: float = 0.6, lists: int | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` vectors of largest inner product found for each query.

    ``is_query`` makes a condition of the id column. Every other usable vector is a candidate. A query probes
    ``share`` of the lists, and more until over ``top`` vectors are reached, so ``top`` rows are returned
    wherever there are as many candidates, and all candidates otherwise. This much is what vectors
    without clear clusters need for a recall above 0.9; clustered ones need far less. Ties go to the smaller
    id. See :func:`usable` for the vectors that take no part; further columns are not read.
    """
    spark = vectors.sparkSession
    rows, dim = usable(vectors, id_col, vector_col)
    rows = staged(rows, "vectors")
    index, n = fit_lists(rows, dim, lists)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    held = spark.sparkContext.broadcast(index)
    k = len(index.centroids)
    probes = max(1, int(np.ceil(share * k)))

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                y = held.value.points(np.stack(part["v"]), query=False)
                yield part.assign(l=(y @ held.value.centroids.T).argmax(axis=1).astype("int32"))

    placed = staged(rows.mapInPandas(assign, "i long, v array<double>, l int"), "lists")
    sizes = {r["l"]: r["count"] for r in placed.groupBy("l").count().collect()}  # one for each list, 4096 at most
    size = np.array([sizes.get(j, 0) for j in range(k)])
    bin_of, room = np.zeros(k, np.int64), 0
    for j in range(k):
        full = j and room + size[j] > SHARD
        bin_of[j], room = (bin_of[j - 1] + full if j else 0), size[j] + (0 if full else room)

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            near = np.argsort(-(held.value.points(np.stack(part["v"]), query=True) @ held.value.centroids.T), axis=1, kind="stable")
            out = []
            for i, v, order in zip(part["i"], part["v"], near):
                order = order[size[order] > 0]
                before = np.cumsum(size[order]) - size[order]
                early = before <= 2 * top
                for now in (True, False):
                    chosen = order[early] if now else order[~early & (np.arange(len(order)) < probes)]
                    for b in np.unique(bin_of[chosen]):
                        out.append((i, v, int(b), now, chosen[bin_of[chosen] == b].astype(np.int32)))
            yield pd.DataFrame(out, columns=["q", "v", "bin", "early", "lists"])

    asked = staged(rows.where(is_query(F.col("i"))).mapInPandas(probe, "q long, v array<double>, bin int, early boolean, lists array<int>"), "probes")
    wanted = {r["bin"]: r["count"] for r in asked.groupBy("bin").count().collect()}  # as many as bins
    total = np.bincount(bin_of, size)
    plan = [(j, int(b), int(max(1, -(-total[b] // SHARD))), int(max(1, -(-wanted.get(b, 0) // QUERIES)))) for j, b in enumerate(bin_of)]
    plan = spark.createDataFrame(plan, "l int, bin int, shards int, blocks int")
    left = placed.join(F.broadcast(plan), "l").withColumn("s", F.pmod(F.xxhash64("i"), F.col("shards")).cast("int"))
    left = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    bins = F.broadcast(plan.select("bin", "shards", "blocks").distinct())
    dealt = asked.join(bins, "bin").withColumn("b", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    def meet(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [np.zeros(0, "int64")], "vec_id": [np.zeros(0, "int64")], "score": [np.zeros(0)]}
        if len(have) and len(ask):
            have = have.sort_values(["l", "i"])
            x, q = np.stack(have["v"]), np.stack(ask["v"])
            y, p = held.value.points(x, query=False), held.value.points(q, query=True)
            ids, own, of = have["i"].to_numpy(), ask["q"].to_numpy(), have["l"].to_numpy()
            # the bound is a score; on the sphere a squared distance
            reach = 2 - 2 * ask["bound"].to_numpy() / (np.linalg.norm(q, axis=1) * held.value.longest**0.5) + 1e-9
            reach = np.where(np.isnan(reach), np.inf, reach)
            asks = np.repeat(np.arange(len(ask)), [len(z) for z in ask["lists"]])
            lists_ = np.concatenate(list(ask["lists"]))
            for j in np.unique(of):
                lo, hi = np.searchsorted(of, [j, j + 1])
                at = asks[lists_ == j]
                if len(at):
                    for i, c, score in scan_list(x[lo:hi], y[lo:hi], ids[lo:hi], q[at], p[at], own[at], reach[at], top):
                        found["query_id"].append(own[at][i])
                        found["vec_id"].append(ids[lo:hi][c])
                        found["score"].append(score)
        return pd.DataFrame({c: np.concatenate(v) for c, v in found.items()})

    keys = ["bin", "s", "b"]
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def search(queries: DataFrame) -> DataFrame:
        asks = queries.select(*keys, "q", "v", "lists", "bound").groupBy(*keys)
        met = left.select(*keys, "l", "i", "v").groupBy(*keys).cogroup(asks).applyInPandas(meet, "query_id long, vec_id long, score double")
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    near = staged(search(dealt.where("early").withColumn("bound", F.lit(None).cast("double"))), "early-hits")
    bound = near.where(F.col("rank") == top).select(F.col("query_id").alias("q"), F.col("score").alias("bound"))
    far = search(dealt.where("not early").join(bound, "q", "left"))
    met = near.drop("rank").unionByName(far.drop("rank"))
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
