"""Language identification by the nearest of several centroids per language.

A text is a bag of hashed character n-grams (1 to 3, letters in lower case, all else one
blank), weighted by TF-IDF and scaled to length one. The vectors of each language are clustered
by cosine; a text gets the language of the nearest centroid. A text is rejected if its cosine to that,
or what it is nearer than to the next language, is less than texts of the language and of about the same
number of n-grams have in the fit, with a margin. Texts of a few common words still pass, as do those of few
words in languages that were not learned; nearly all longer texts in these do not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import fitted, hash_share
from featureloom.llm.text import LETTER, blocks, char_classes, code_points, cut_text

DIM = 4096
ROWS = 96  # texts whose dense counts are held at once
CUTS = [12 << k for k in range(8)]  # characters of the pieces whose cosines are looked at besides those of whole texts
KNOTS = np.arange(4.0, 14.0)  # log2 of n-grams at which the bounds of a language are known
SURE = 8.0  # log2 of n-grams from which the distance to the next language counts (about 16 words)
_LETTER = regex.compile(r"\p{L}")


def ngram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams, one row for each text; a long text is counted in parts."""
    parts = [cut_text(t.lower()) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
    flat = [p for x in parts for p in x]
    out = np.zeros((len(texts), DIM), np.float32)
    for lo, hi in blocks([len(p) for p in flat]):
        _, cp, ends = code_points(flat[lo:hi])
        letter = char_classes()[cp] == LETTER
        keep = letter | np.concatenate([[True], letter[:-1]])  # of other characters in a row the first
        c = np.where(letter, cp, 32)[keep]
        row = owner[lo + np.repeat(np.arange(hi - lo), np.diff(ends, prepend=-1))][keep]
        h = c.astype(np.uint32)
        for n in range(1, 4):
            if n > 1:
                h = h[:-1] * np.uint32(0x9E3779B1) + c[n - 1 :]
            mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B) + np.uint32(n * 0x27D4EB2F)
            bucket = (mixed ^ mixed >> np.uint32(13)) * np.uint32(0xC2B2AE35) >> np.uint32(20)
            same = row[: len(h)] == row[n - 1 :]
            first, last = int(row[0]), int(row[-1])
            cell = (row[: len(h)][same] - first) * DIM + bucket[same]
            out[first : last + 1] += np.bincount(cell, minlength=(last - first + 1) * DIM).reshape(-1, DIM)
    return out


def pieces(text: str) -> list[str]:
    """The text and a piece of each shorter length from a place given by its checksum."""
    at = zlib.crc32(text.encode("utf-8", "replace"))
    starts = [(n, at * 2654435761 % (1 << 32) % (len(text) - n)) for n in CUTS if n < len(text)]
    return [text] + [text[a : a + n] for n, a in starts]


def lengths(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts.sum(axis=1))


def bound(values: np.ndarray, length: np.ndarray, share: float, least: int = 20) -> np.ndarray:
    """The quantile of values at each knot, from those of about its length; of all where no knot has enough."""
    near = [values[abs(length - k) < 0.75] for k in KNOTS]
    known = [k for k, v in enumerate(near) if len(v) >= least]
    if not known:
        return np.full(len(KNOTS), np.quantile(values, share))
    return np.interp(KNOTS, KNOTS[known], [np.quantile(near[k], share) for k in known])


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    owner: np.ndarray  # language of each centroid
    floor: np.ndarray  # least cosine with which a language is accepted, by language and knot
    apart: np.ndarray  # least distance of that to the cosine of the next language

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts)
        x *= self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        return x

    def nearest(self, counts: np.ndarray) -> np.ndarray:
        """Cosine to the nearest centroid of each language."""
        cosine = self.vectors(counts) @ self.centroids.T
        return np.stack([cosine[:, self.owner == k].max(axis=1) for k in range(len(self.languages))], axis=1)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score, cosine to the nearest centroid, whether it is rejected."""
        best = self.nearest(counts)
        choice = best.argmax(axis=1)
        near = np.take_along_axis(best, choice[:, None], axis=1)[:, 0]
        odds = np.exp(30 * (best - near[:, None]))
        ahead = near - over_others(best, choice)
        length = lengths(counts)
        low = [near[r] < np.interp(length[r], KNOTS, self.floor[k]) or ahead[r] < np.interp(length[r], KNOTS, self.apart[k]) for r, k in enumerate(choice)]
        return choice, 1 / odds.sum(axis=1), near, np.array(low, bool)


def over_others(best: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The highest cosine of each row but that of its own language (-1 if there is no other)."""
    rest = best.copy()
    rest[np.arange(len(rest)), own] = -1
    return rest.max(axis=1)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of unit rows, started from rows far from each other."""
    centres = [x.mean(axis=0)]
    while len(centres) < min(k, len(x)):
        centres.append(x[(x @ np.stack(centres).T).max(axis=1).argmin()])
    c = np.stack(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit_languages(
    labelled: DataFrame, per_language: int = 800, clusters: int = 4, near: float = 0.8, ahead: float = 0.4,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> LanguageModel | None:
    """Fit on about ``per_language`` whole texts of each language, drawn by hash; the bound of the fit.

    A text is accepted from ``near`` times the 0.01 quantile of cosines and, unless it is short, ``ahead`` times the
    0.05 quantile of their distances to those of the next language. Pieces of the texts tell these quantiles of short texts.
    Rows with a null text or language or without a letter do not take part. Texts are counted on the
    executors, and the fit of their at most ``DIM`` counts is one task there. None if no row is left.
    """
    usable = labelled.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang"))
    usable = usable.where("lang is not null and t is not null")
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | (F.col("lang").eqNullSafe(F.lit(lang)) & hash_share(n, per_language, "i"))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part[[has_letter(t) for t in part["t"]]]
            for lo in range(0, len(part), ROWS):
                some = part.iloc[lo : lo + ROWS]
                cut = [(r, k, t) for r, text in enumerate(some["t"]) for k, t in enumerate(pieces(text)) if not k or has_letter(t)]
                for first in range(0, len(cut), ROWS):
                    rows, kinds, texts = zip(*cut[first : first + ROWS])
                    dense = ngram_counts(list(texts))
                    at = [np.flatnonzero(r).astype("<u2") for r in dense]
                    of = some.iloc[list(rows)]
                    yield pd.DataFrame({
                        "i": of["i"].astype("string").to_numpy(), "lang": of["lang"].to_numpy(), "cut": kinds, "at": [a.tobytes() for a in at],
                        "n": [r[a].astype("<f4").tobytes() for r, a in zip(dense, at)],
                    })

    def dense(rows: pa.Table) -> np.ndarray:
        counts = np.zeros((len(rows), DIM), np.float32)
        for r, (at, n) in enumerate(zip(rows["at"], rows["n"])):
            counts[r, np.frombuffer(at.as_buffer(), "<u2")] = np.frombuffer(n.as_buffer(), "<f4")
        return counts

    every = usable.where(chosen).mapInPandas(count, "i string, lang string, cut int, at binary, n binary")
    most = 2 * per_language * len(sizes)

    def fit(every: pa.Table) -> LanguageModel:
        # The rows stay as they came, a few bytes for each count; dense ones are made for one language, or for 500 rows.
        whole = every.filter(pc.equal(every["cut"], 0)).slice(0, most)
        languages = sorted(pc.unique(whole["lang"]).to_pylist())
        seen = np.zeros(DIM, np.int64)
        for at in whole["at"]:
            seen[np.frombuffer(at.as_buffer(), "<u2")] += 1
        idf = (np.log((1 + len(whole)) / (1 + seen)) + 1).astype(np.float32)
        model = LanguageModel(languages, idf, np.zeros((0, DIM), np.float32), np.zeros(0, int), np.zeros((0, len(KNOTS))), np.zeros((0, len(KNOTS))))
        centres = [cluster(model.vectors(dense(whole.filter(pc.equal(whole["lang"], lang)))), clusters) for lang in languages]
        model.centroids = np.concatenate(centres).astype(np.float32)
        model.owner = np.repeat(np.arange(len(languages)), [len(c) for c in centres])
        floor, apart = [], []
        for k, lang in enumerate(languages):
            own = every.filter(pc.equal(every["lang"], lang))
            told = [(model.nearest(c), lengths(c)) for c in (dense(own.slice(lo, 500)) for lo in range(0, len(own), 500))]
            best, length = (np.concatenate(v) for v in zip(*told))
            floor.append(near * bound(best[:, k], length, 0.01))
            apart.append(np.where(KNOTS < SURE, -1, ahead * bound(best[:, k] - over_others(best, np.full(len(best), k)), length, 0.05)))
        model.floor, model.apart = np.array(floor), np.array(apart)
        return model

    return fitted(every.orderBy("cut", "lang", "i", "at").limit(most * (1 + len(CUTS))), fit)


def predict_languages(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``, ``lang_cosine``, ``lang_rejected``.

    ``und`` (score 0, rejected) for a null text, one without a letter, or an empty model. Whole
    texts of any length are read; repeated rows stay and agree; columns of these four names
    are replaced; an empty table stays empty. Of equally near languages the first by name.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, lang_cosine double, lang_rejected boolean")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for part in parts:
            texts = list(part)
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            cosine, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
            good = np.array([i for i, t in enumerate(texts) if m is not None and has_letter(t)], int)
            for lo in range(0, len(good), ROWS):
                at = good[lo : lo + ROWS]
                k, score[at], cosine[at], rejected[at] = m.predict(ngram_counts([texts[i] for i in at]))
                lang[at] = [m.languages[j] for j in k]
            yield pd.DataFrame({"lang_pred": lang, "score": score, "lang_cosine": cosine, "lang_rejected": rejected})

    names = ["lang_pred", "score", "lang_cosine", "lang_rejected"]
    kept = [c for c in docs.columns if c.lower() not in names]
    out = docs.withColumn("__lang", run(F.col(text_col)))
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__lang.{n}").alias(n) for n in names])
