"""BPE encoding and decoding with an index of pair occurrences.

The distinct new words of a batch lie in one symbol array. The index maps every pair that has
a rank to all its positions; the active ranks are taken in ascending order from a heap, each
is applied at all its positions at once, and only the lists of the pairs that this changes are
updated. A vocabulary whose pairs are not ranked after the merges that make their parts
would need another order and is refused.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureloom.llm.text import WordCache, encode_texts


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class PairIndexBPE:
    """A byte-level BPE vocabulary in a tokenizers JSON file.

    Two kinds are known: with word ends (NFC, lower case, white space dropped) and, without a
    normaliser, with blanks that belong to the word behind them.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.spaced = spec["normalizer"] is None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        signs = byte_symbols()
        self.inner = np.array([vocab[s] for s in signs], np.int64)
        self.final = np.array([vocab[s + suffix] for s in signs], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        born = np.full(max(vocab.values()) + 1, -1)
        born[made[::-1]] = np.arange(len(made))[::-1]
        if (np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("a pair is ranked before a merge that makes one of its parts")
        self.left, self.right, self.made = left, right, made
        code = left << 32 | right
        self.order = np.argsort(code)
        self.codes = code[self.order]
        words = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.shown = [(words.get(i, "") + " ").encode() for i in range(max(words) + 1)]
        self.splits = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.cache = WordCache(self.encode_words)

    def ranks(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.order[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of some words, and how many each has."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum(size)
        sym = self.inner[data]
        sym[end - 1] = self.final[data[end - 1]]
        nxt = np.arange(1, len(sym) + 1)
        nxt[end - 1] = -1
        prv = np.arange(-1, len(sym) - 1)
        prv[end - size] = -1
        self._merge(sym, nxt, prv)
        alive = sym >= 0
        return sym[alive].astype(np.int32), np.add.reduceat(alive, end - size).astype(np.int32) if len(raw) else np.zeros(0, np.int32)

    def _merge(self, sym: np.ndarray, nxt: np.ndarray, prv: np.ndarray) -> None:
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions on their lists."""
            rank = self.ranks(sym[at] << 32 | sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            edges = [0, *cut.tolist(), len(at)]
            for lo, hi, r in zip(edges, edges[1:], rank[np.concatenate([[0], cut])].tolist()):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(at[lo:hi])

        enter(np.flatnonzero(nxt >= 0))
        while active:
            r = heapq.heappop(active)
            found = index.pop(r)
            pos = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            left, right = self.left[r], self.right[r]
            after = nxt[pos]
            good = (sym[pos] == left) & (after >= 0) & (sym[after] == right)
            pos, after = pos[good], after[good]
            if not len(pos):
                continue
            if left == right:  # of a run of overlapping pairs, every second one from the left
                head = np.concatenate([[True], after[:-1] != pos[1:]])
                at = np.arange(len(pos))
                keep = (at - np.maximum.accumulate(np.where(head, at, 0))) % 2 == 0
                pos, after = pos[keep], after[keep]
            sym[pos], sym[after] = self.made[r], -1
            beyond = nxt[after]
            nxt[pos] = beyond
            more = beyond >= 0
            prv[beyond[more]] = pos[more]
            before = prv[pos]
            enter(np.unique(np.concatenate([pos[more], before[before >= 0]])))

    @staticmethod
    def normalise(text: str) -> str:
        """NFC and lower case, each character on its own (so a final sigma is not special)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; the strings of special tokens are these tokens."""
        segments: list[tuple[int, int, str]] = []
        for i, text in enumerate(texts):
            if "<|" in text:
                segments += [(i, self.special.get(x, -1), x) for x in self.splits.split(text) if x]
            else:
                segments.append((i, -1, text))
        plain = [x if self.spaced else self.normalise(x) for _, special, x in segments if special < 0]
        encoded = iter(encode_texts(plain, self.cache, self.spaced))
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, special, _ in segments:
            out[i].append(np.array([special], np.int32) if special >= 0 else next(encoded))
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.int32), *x]) for x in out]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with a blank between them, in UTF-8."""
        shown = self.shown
        return b"".join([shown[i] for i in ids.tolist()])[:-1]


@lru_cache(2)
def load(path: str) -> PairIndexBPE:
    """The vocabulary, read once in each worker."""
    return PairIndexBPE(path)


def encode_column(path: str, text: Column) -> Column:
    """Ids of a text column (null: no ids), as an array of integers."""

    @F.pandas_udf("array<int>")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(path)
        for part in parts:
            yield pd.Series(model.encode([t or "" for t in part]), dtype=object)

    return ids(text)


def decode_column(path: str, ids: Column) -> Column:
    """The decoded text of an array of ids (null: an empty text)."""

    @F.pandas_udf("string")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(path)
        for part in parts:
            yield pd.Series([model.decode(np.asarray([] if x is None else x, np.int64)).decode() for x in part], dtype=object)

    return texts(ids)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and return sizes and digests only.

    One row per input row, in no order: ``id_col``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``. A null or empty text has no tokens; null ids and repeated rows stay;
    further columns are not read; an empty table gives no rows. Nothing is shuffled.
    """
    from hashlib import sha256

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path)
        for part in parts:
            ids = model.encode([t or "" for t in part["t"]])
            yield pd.DataFrame({
                "i": part["i"],
                "n_tokens": [len(x) for x in ids],
                "ids_sha256": [sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [sha256(model.decode(x)).hexdigest() for x in ids],
            })

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return slim.mapInPandas(run, f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("i", id_col)
