"""Quality classifier with learned subword embeddings.

Every word and character n-gram is hashed to a learned vector; a document is the mean of its
vectors, and a softmax layer gives the class. Both are trained by stochastic gradient descent
in numpy on a bounded sample of labelled rows. As the layer is linear, scoring uses the
inner product of every vector with the layer, computed once: one number for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import fitted, hash_share, whole_text
from featureloom.llm.text import EDGE, SPACE, blocks, char_classes, code_points, cut_text, mix, prefix_hashes, span_hashes

BUCKET_BITS = 16
NGRAMS = (3, 4)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all words and n-grams of the texts, with the number of the text, block by block."""
    parts = [cut_text(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
    flat = [p for x in parts for p in x]
    shift = np.uint64(64 - BUCKET_BITS)
    for lo, hi in blocks([len(p) for p in flat]):
        _, cp, ends = code_points(flat[lo:hi])
        row = owner[lo + np.repeat(np.arange(hi - lo), np.diff(ends, prepend=-1))]
        kind = char_classes()[cp]
        kind[ends] = EDGE
        solid = np.concatenate([[False], kind < SPACE, [False]])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        start, end = edge[::2], edge[1::2]
        prefix = prefix_hashes(cp)
        if len(start):
            yield (mix(span_hashes(prefix, start, end)) >> shift).astype(np.int64), row[start]
        inside = np.repeat(ends, np.diff(ends, prepend=-1))  # separator behind each place
        for n in NGRAMS:
            at = np.flatnonzero(np.arange(len(cp)) + n <= inside)
            if len(at):
                yield (mix(span_hashes(prefix, at, at + n) + np.uint64(n)) >> shift).astype(np.int64), row[at]


@dataclass
class QualityModel:
    weight: np.ndarray  # of each bucket: its vector times the difference of the softmax rows
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for bucket, row in features(texts):
            total += np.bincount(row, self.weight[bucket], len(texts))
            count += np.bincount(row, minlength=len(texts))
        logit = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def train(
    buckets: pa.ChunkedArray, shares: pa.ChunkedArray, labels: np.ndarray, dim: int = 16, epochs: int = 12, rate: float = 4.0, seed: int = 11,
) -> QualityModel:
    """Gradient descent, one document at a time.

    ``buckets`` (two bytes each) and ``shares`` (four bytes) of a document are a value of a binary column; only those of the
    document at hand are widened, so the task holds six bytes for each feature of the sample.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BUCKET_BITS, dim))
    layer, bias = rng.uniform(-1, 1, (dim, 2)), np.zeros(2)
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            lr = rate * (1 - done / steps)
            done += 1
            at = np.frombuffer(buckets[i].as_buffer(), "<u2").astype(np.int64)
            share = np.frombuffer(shares[i].as_buffer(), "<f4").astype(float)
            own = vectors[at]
            mean = share @ own
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= 0.1 * lr * np.outer(mean, p)
            bias -= 0.01 * lr * p
            # a share is small: the step of a vector is scaled up to that of a document of equal features
            vectors[at] = own - lr * (share / share.max())[:, None] * 0.1 * back
    return QualityModel(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def one_label(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """``(id, label)`` with one row for each id: the least label where rows disagree; nulls count only where there is nothing else."""
    return labels.groupBy(id_col).agg(F.min(label_col).alias(label_col))


def fit_quality(
    labelled: DataFrame, sample: int = 4000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> QualityModel:
    """Fit on about ``sample`` whole labelled texts, drawn by hash; the bound of the fit.

    Null labels do not take part; null texts are empty. The bags of the texts are made on the
    executors and hold at most one number for each bucket; the fit is one task there. Without rows every score is 0.5.
    """
    usable = labelled.select(F.col(id_col).alias("i"), whole_text(text_col).alias("t"), F.col(label_col).cast("int").alias("y")).where("y is not null")

    def bag(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for t in part["t"]:
                found = [b for b, _ in features([t])]
                at, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, int), np.zeros(0))
                rows.append((at.astype("<u2").tobytes(), (n / max(1, n.sum())).astype("<f4").tobytes()))
            yield pd.DataFrame({"i": part["i"].astype("string"), "y": part["y"], "at": [r[0] for r in rows], "n": [r[1] for r in rows]})

    rows = usable.where(hash_share(usable.count(), sample, "i")).mapInPandas(bag, "i string, y int, at binary, n binary")

    def fit(bags: pa.Table) -> QualityModel | None:
        bags = bags.sort_by([("i", "ascending"), ("y", "ascending"), ("at", "ascending")]).combine_chunks()
        bags = bags.filter(pc.greater(pc.binary_length(bags["at"]), 0))
        return train(bags["at"], bags["n"], (bags["y"].to_numpy() > 0).astype(int)) if len(bags) else None

    return fitted(rows.limit(2 * sample), fit) or QualityModel(np.zeros(1 << BUCKET_BITS), 0.0)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, ``score`` (probability of label 1) and ``predicted`` (1 from 0.5 on).

    Whole texts of any length are read. A null or empty text has no features and gets the score of the
    bias alone; repeated rows agree; columns of these two names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(held.value.score(list(part)))

    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    out = docs.select(*[F.col(f"`{c}`") for c in kept], run(whole_text(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
