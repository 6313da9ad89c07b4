"""Packing along a space-filling curve.

Every document becomes a hashed bag of token ids, scaled to length one and projected to four
dimensions. The Hilbert key of these (after centring and scaling with the corpus mean and
deviation) orders the corpus, so neighbours along the curve are alike. The token stream in
this order is cut every ``length`` tokens: only the last sequence can be short.

The order is total over all rows, but no task sees more than its range of keys: approximate
quantiles of (key, document hash) give ranges of about equal size, the tokens of each range are
summed, and the sums before a range (one number for each range) place its first document.
Copies with one key are told apart by the document hash, so a large group of them is split.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureloom.llm.bpe import load
from featureloom.llm.shared import partitions, staged, whole_text

DIMS, BITS, BUCKETS, TIE_BITS = 4, 8, 256, 20
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of points with ``bits`` bits in each dimension (rows: points)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of the curve's construction, from the coarsest cell on
        low = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _projection(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket for every token id, and the matrix from buckets to few dimensions."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, BUCKETS, 1 << 17), rng.standard_normal((BUCKETS, DIMS))


def tokenized(docs: DataFrame, path: str, separator: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """Ids (little-endian unsigned 16 or 32 bits, with the separator), their number, coordinates, a tie-break."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path)
        kind = "<u2" if len(model.shown) <= 1 << 16 else "<u4"
        bucket, matrix = _projection(seed)
        for part in parts:
            ids = model.encode(list(part["t"]))
            bags = np.stack([np.bincount(bucket[x], minlength=BUCKETS) for x in ids]) if ids else np.zeros((0, BUCKETS))
            bags = np.sqrt(bags)
            bags /= np.maximum(np.linalg.norm(bags, axis=1, keepdims=True), 1e-12)
            at = bags @ matrix
            yield pd.DataFrame({
                "i": part["i"], "h": part["h"], "n": [len(x) + 1 for x in ids],
                "ids": [np.append(x, separator).astype(kind).tobytes() for x in ids],
                **{f"c{d}": at[:, d] for d in range(DIMS)},
            })

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("i"), whole_text(text_col).alias("t"))
    slim = slim.withColumn("h", F.xxhash64("i", "t"))
    return slim.mapInPandas(run, f"i {kind}, h long, n long, ids binary, " + ", ".join(f"c{d} double" for d in range(DIMS)))


def pack_documents(
    docs: DataFrame, path: str, length: int = 1024, separator: int = 0, seed: int = 7,
    with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of ``length`` tokens; one row for each piece of a document.

    A document is its ids and then ``separator``. Rows: the id, ``start`` (ids of the document
    before the piece), ``length``, ``ids_crc32`` (of little-endian unsigned 32-bit ids),
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence; ``with_ids`` adds ``ids``.
    Null and empty texts are the separator alone. Null ids and repeated rows are packed like any
    other row; further columns are not read; an empty table gives no rows. A text longer than a
    sequence runs over several. Equal keys are ordered by a hash of id and text.
    """
    table = staged(tokenized(docs, path, separator, seed, id_col, text_col), "packing-tokens")
    axes = [f"c{d}" for d in range(DIMS)]
    stats = table.agg(*[F.avg(c).alias(f"m{c}") for c in axes], *[F.stddev_pop(c).alias(f"s{c}") for c in axes], F.count("*").alias("n")).first()
    mean = np.array([stats[f"m{c}"] or 0.0 for c in axes])
    scale = np.array([stats[f"s{c}"] or 1.0 for c in axes])
    ranges = partitions(docs)

    @F.pandas_udf("long")
    def order_of(c0: pd.Series, c1: pd.Series, c2: pd.Series, c3: pd.Series, h: pd.Series) -> pd.Series:
        at = np.stack([c0, c1, c2, c3], axis=1)
        cells = np.clip((np.clip((at - mean) / scale, -3, 3) + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1)
        return pd.Series(hilbert_key(cells) << TIE_BITS | h.to_numpy() & (1 << TIE_BITS) - 1)

    keyed = table.withColumn("k", order_of(*axes, "h")).drop(*axes)
    share = [i / ranges for i in range(1, ranges)]
    bounds = np.array(keyed.agg(F.percentile_approx("k", share, 20 * ranges)).first()[0] if share and stats["n"] else [], np.int64)

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32))

    keyed = keyed.withColumn("r", range_of("k"))
    sums = {r["r"]: r["n"] for r in keyed.groupBy("r").agg(F.sum("n").alias("n")).collect()}
    base, total = {}, 0
    for r in sorted(sums):
        base[r], total = total, total + sums[r]

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, at = None, 0
        for part in parts:
            cols: dict[str, list] = {c: [] for c in ("i", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)}
            for i, n, ids, r in zip(part["i"], part["n"], part["ids"], part["r"]):
                if r != current:
                    current, at = r, base[r]
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    size = min(n - start, length - at % length)
                    piece = wide[start : start + size]
                    for c, v in zip(cols, (i, start, size, crc32(piece.tobytes()), n, at // length, at % length, piece.astype(np.int64))):
                        cols[c].append(v)
                    start, at = start + size, at + size
            yield pd.DataFrame(cols)

    kind = docs.schema[id_col].dataType.simpleString()
    placed = (
        keyed.select("i", "n", "ids", "r", "k", "h")
        .repartition(ranges, "r").sortWithinPartitions("r", "k", "i", "h")
        .mapInPandas(place, f"i {kind}, {PIECES}" + ", ids array<long>" * with_ids)
    )
    return placed.withColumnRenamed("i", id_col)
