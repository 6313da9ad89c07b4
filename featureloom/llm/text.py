"""Texts as arrays: code points, pre-token pieces, polynomial hashes, a cache of encoded words.

The functions here are called inside tasks on blocks of whole texts. A block holds about
``BLOCK`` characters, so memory does not depend on the size of an Arrow batch; a longer text
is cut before a blank that follows a non-blank, where no piece of either pattern can continue.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import regex

BLOCK = 400_000
OTHER, LETTER, NUMBER, SPACE, EDGE = range(5)
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_LIMIT = 64
# White space of the tokenizers' patterns (Unicode White_Space): fixed values.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CUT = regex.compile(r"(?<=[^\s\x85\x1c-\x1f])[ \n]")


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space, other."""
    every = "".join(map(chr, range(0x110000)))
    table = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    table[_SPACES] = SPACE
    return table


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    up, down = np.full(n, base), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of at least ``n`` powers; sizes are rounded up so that few are kept."""
    return powers(1 << max(16, int(n).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (in a copy)."""
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """``P`` with ``P[i]`` the sum of ``(values[j] + 1) * base**j`` over ``j < i``, modulo 2**64."""
    up, _ = power_tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span, the same wherever the span lies."""
    _, down = power_tables(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def blocks(sizes: list[int], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of items with ``limit`` characters together, or a single longer item."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def cut_text(text: str, limit: int = BLOCK) -> list[str]:
    """``[text]``, or parts of about ``limit`` characters, each but the first starting at a blank."""
    if len(text) <= limit:
        return [text]
    parts, at = [], 0
    while len(text) - at > limit:
        m = _CUT.search(text, at + limit)
        if m is None:
            break
        parts.append(text[at : m.start()])
        at = m.start()
    return [*parts, text[at:]]


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The joined texts, one separator behind each, their code points, the separators' places."""
    joined = "\0".join([*texts, ""])
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return joined, cp, np.cumsum([len(t) + 1 for t in texts]) - 1


def _contractions(cp: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
    """Let 's 't 'm 'd 're 've 'll be pieces of their own where a piece starts with the apostrophe."""
    at = np.flatnonzero(start & (cp == 39))
    if not len(at):
        return
    padded = np.concatenate([cp, np.zeros(3, np.uint32)])
    a, b = padded[at + 1], padded[at + 2]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
    size = np.where(one, 2, np.where(two, 3, 0))
    at, size = at[size > 0], size[size > 0]
    start[at + 1] = False
    after = at + size
    after = after[(after < len(cp))]
    start[after[kind[after] == LETTER]] = True


def pieces(texts: list[str], spaced: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(joined texts, code points, starts, ends, text number)`` of the pre-token pieces.

    ``spaced``: the byte-level pattern, where a blank belongs to the piece behind it and other
    white space forms pieces. Otherwise the word pattern: runs of letters, single numbers,
    runs of other characters, white space dropped.
    """
    joined, cp, ends = code_points(texts)
    kind = char_classes()[cp]
    kind[ends] = EDGE
    before = np.concatenate([[np.uint8(EDGE)], kind[:-1]])
    solid = kind < SPACE
    if spaced:
        start = solid & (kind != before)
        tied = np.flatnonzero(start & (before == SPACE))
        tied = tied[cp[tied - 1] == 32]
        start[tied] = False
        space = kind == SPACE
        follows = np.concatenate([kind[1:], [np.uint8(EDGE)]])
        start |= space & ((before != SPACE) | (follows < SPACE))
        _contractions(cp, kind, start)
        stop = start | (kind == EDGE)
    else:
        start = solid & ((kind != before) | (kind == NUMBER))
        _contractions(cp, kind, start)
        stop = start | (kind >= SPACE)
    at = np.flatnonzero(stop)
    first = start[at]
    end = np.concatenate([at[1:], [len(cp)]])
    s, e = at[first], end[first]
    each = np.diff(np.searchsorted(s, ends), prepend=0)
    return joined, cp, s, e, np.repeat(np.arange(len(texts)), each)


def piece_hashes(cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    h = span_hashes(prefix_hashes(cp), start, end)
    return mix(h ^ ((end - start).astype(np.uint64) << np.uint64(57)))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and the number of each key among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    back = np.empty(len(keys), np.int32)
    back[order] = np.cumsum(head, dtype=np.int32) - 1
    return ranked[head], order[head], back


class WordCache:
    """Token ids of words by a 64-bit hash of the word, in sorted arrays; ``encode`` fills it.

    ``encode`` returns the concatenated ids of some words and how many each has. Words of over
    64 characters, where polynomial hashes could be made to agree, are told apart by their
    text. A batch that finds over ``limit`` words lets the cache start again.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_500_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        empty = lambda kind: np.zeros(0, kind)
        self.levels = [(empty(np.uint64), empty(np.int64), empty(np.int32)) for _ in range(2)]
        self.pool, self.used, self.long = np.zeros(1 << 16, np.int32), 0, {}

    def _store(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, size = self.encode(words)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        offset = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += len(ids)
        return offset, size

    def full(self) -> bool:
        return sum(len(k) for k, *_ in self.levels) + len(self.long) > self.limit

    def missing(self, keys: np.ndarray) -> np.ndarray:
        return self._find(keys)[1] < 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        offset, size = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int32)
        for k, o, n in self.levels:
            if len(k):
                i = np.minimum(np.searchsorted(k, keys), len(k) - 1)
                hit = k[i] == keys
                offset[hit], size[hit] = o[i[hit]], n[i[hit]]
        return offset, size

    def add(self, keys: np.ndarray, words: list[str]) -> None:
        """Encode the words of new, distinct keys."""
        if not len(keys):
            return
        order = np.argsort(keys)
        offset, size = self._store(words)
        new = (keys[order], offset[order], size[order])
        merge = lambda a, b: tuple(np.insert(x, at, y) for x, y in zip(a, b)) if len(at := np.searchsorted(a[0], b[0])) else a
        self.levels[1] = merge(self.levels[1], new)
        if len(self.levels[1][0]) > 100_000:
            self.levels = [merge(self.levels[0], self.levels[1]), tuple(x[:0] for x in self.levels[1])]

    def ids(self, keys: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of the words with the known keys ``keys[back]``, and how many each has."""
        offset, size = (x[back] for x in self._find(keys))
        total = np.cumsum(size, dtype=np.int64)
        at = np.repeat(offset - total + size, size) + np.arange(total[-1] if len(total) else 0)
        return self.pool[at], size


def encode_texts(texts: list[str], cache: WordCache, spaced: bool) -> list[np.ndarray]:
    """Ids of every text: all new words of the batch are encoded together, then ids are laid out."""
    if cache.full():
        cache.clear()
    parts = [cut_text(t) for t in texts]
    flat = [p for x in parts for p in x]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
    known, new = [], {}
    for lo, hi in blocks([len(p) for p in flat]):
        joined, cp, s, e, text = pieces(flat[lo:hi], spaced)
        keys = piece_hashes(cp, s, e)
        for i in np.flatnonzero(e - s > _WORD_LIMIT).tolist():
            keys[i] = cache.long.setdefault(joined[s[i] : e[i]], len(cache.long) + 1)
        keys, first, back = distinct(keys)
        absent = cache.missing(keys)
        at = first[absent]
        for k, i, j in zip(keys[absent].tolist(), s[at].tolist(), e[at].tolist()):
            if k not in new:
                new[k] = joined[i:j]
        known.append((keys, back, owner[lo + text]))
    cache.add(np.fromiter(new, np.uint64, len(new)), list(new.values()))
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for keys, back, text in known:
        if not len(text):
            continue
        ids, size = cache.ids(keys, back)
        edge = np.concatenate([[0], np.cumsum(size)])
        cut = np.flatnonzero(np.diff(text)) + 1
        low, high = np.concatenate([[0], cut]), np.concatenate([cut, [len(text)]])
        for i, lo, hi in zip(text[low].tolist(), edge[low].tolist(), edge[high].tolist()):
            out[i].append(ids[lo:hi])
    return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]
