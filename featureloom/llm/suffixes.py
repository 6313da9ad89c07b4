"""Exact substring dedup with a hash-compared suffix sort.

A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller id.

Equal strings of ``width`` bytes pick the same anchor inside them: the ``SEED``-byte substring with the
least hash, the first of equals. So only strings with one anchor need to meet. A run of
windows with one anchor is a chunk: its bytes go to the anchor's bucket, and that only if the anchor
occurs in two documents at least. In a bucket the suffixes at the windows are sorted by
mergesort; two suffixes are compared through the prefix polynomial hashes of the bucket's text,
with a binary search for their common extension, and neighbours that seem equal are compared
byte by byte. Windows at different distances from their anchor differ, and so do windows with other first or last bytes,
so each (anchor, distance, first and last eight bytes) is a list of its own; all lists are sorted side by side in numpy, and those whose
neighbours are all equal are in order as they are.

Copies do not pile up: a task sends an anchor that it has seen in several documents once, and of
equal chunks those of the smallest document; the others are settled where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import LAST, partitions, whole_text
from featureloom.llm.text import mix, power_tables, prefix_hashes, span_hashes

SEED = 20
PART = 1 << 16  # bytes hashed or sorted at once: their numbers stay in the cache of a core
FLUSH, ROWS = 24 << 20, 1 << 16  # bytes and texts that a task looks at before it sends
KEY = np.uint64((1 << 48) - 1)  # of an anchor's hash travels; more bits only spare false candidates


def chunks_of(data: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``(first window, last window, anchor place, anchor hash)`` of each chunk of concatenated texts.

    ``row`` numbers the text of each byte; windows do not cross texts.
    """
    n = len(data) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    span = width - SEED + 1
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - SEED + 1)
    h = mix((prefix[SEED:] - prefix[:-SEED]) * power_tables(len(prefix))[1][: len(at)])  # span_hashes of every place
    low = np.uint64((1 << 24) - 1)
    least = (h & ~low) | at.astype(np.uint64)
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    owner = (least & low).astype(np.int64)
    valid = row[:n] == row[width - 1 :]
    fresh = np.ones(n, bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | ~valid[:-1]
    first = np.flatnonzero(fresh & valid)
    closing = np.ones(n, bool)
    closing[:-1] = fresh[1:] | ~valid[1:]
    last = np.flatnonzero(closing & valid)
    return first, last, owner[first], h[owner[first]]


def text_chunks(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text number, first window, last window, anchor place, anchor hash)``, places within the text.

    Texts are hashed together up to ``PART`` bytes; a longer one in parts that overlap by a window.
    """
    batch: list[tuple[int, int, bytes]] = []

    def work():
        size = [len(b) for _, _, b in batch]
        data = np.frombuffer(b"".join(b for _, _, b in batch), np.uint8)
        row = np.repeat(np.arange(len(batch)), size)
        first, last, anchor, h = chunks_of(data, row, width)
        own = row[first]
        shift = (np.array([s for _, s, _ in batch]) - (np.cumsum(size) - size))[own]
        return np.array([i for i, _, _ in batch])[own], first + shift, last + shift, anchor + shift, h

    held = 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - width + 1), PART):
            piece = text[start : start + PART + width - 1]
            if len(piece) < width:
                continue
            if held and held + len(piece) > PART:
                yield work()
                batch, held = [], 0
            batch.append((i, start, piece))
            held += len(piece)
    if batch:
        yield work()


def _flushes(parts: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[dict[str, list]]:
    """Rows gathered up to ``FLUSH`` bytes of text (or one longer text), with the text in UTF-8."""
    held: dict[str, list] = {c: [] for c in columns}
    size = 0
    for part in parts:
        for values in zip(*[part[c] for c in columns]):
            values = list(values)
            values[0] = values[0].encode("utf-8", "surrogatepass")
            if held[columns[0]] and (size + len(values[0]) > FLUSH or len(held[columns[0]]) == ROWS):
                yield held
                held, size = {c: [] for c in columns}, 0
            size += len(values[0])
            for c, v in zip(columns, values):
                held[c].append(v)
    if held[columns[0]]:
        yield held


def _pack(keys: np.ndarray) -> bytes:
    """Six bytes for each key."""
    return keys.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts and ends."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut, [len(values)]]).astype(np.int64)


ASKED = "b int, o long, h long, keys binary, docs binary, own binary, tell binary"


def _ask(parts: Iterator[pd.DataFrame], width: int, buckets: int) -> Iterator[pd.DataFrame]:
    """The anchors of each task for their buckets; anchors seen in several documents answer at once."""
    for held in _flushes(parts, ["t", "o", "h"]):
        found = [k << np.uint64(16) | d.astype(np.uint64) for d, *_, k in text_chunks(held["t"], width)]
        if not found:
            continue
        both = np.sort(np.concatenate(found))  # 48 bits of the key, 16 of the text number
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        key, doc = both >> np.uint64(16), (both & np.uint64(ROWS - 1)).astype(np.int64)
        head = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(head) - 1
        size = np.bincount(group)[group]
        o, h = np.array(held["o"], np.int64), np.array(held["h"], np.int64)
        rows = []
        known = np.flatnonzero(size > 1)
        known = known[np.argsort(doc[known], kind="stable")]
        if len(known):
            for lo, hi in zip(*_runs(doc[known])):
                d = doc[known[lo]]
                rows.append((int(h[d]) % buckets, o[d], h[d], _pack(key[known[lo:hi]]), None, None, None))
        sent = np.flatnonzero(head)
        bucket = (key[sent] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket * ROWS + doc[sent])
        sent, bucket = sent[order], bucket[order]
        for lo, hi in zip(*_runs(bucket)):
            at = sent[lo:hi]
            table, own = np.unique(doc[at], return_inverse=True)
            rows.append((
                int(bucket[lo]), 0, 0, _pack(key[at]), np.stack([o[table], h[table]]).astype("<i8").tobytes(),
                np.diff(own, prepend=0).astype("<u2").tobytes(), np.packbits(size[at] == 1).tobytes(),
            ))
        yield _frame(rows, ASKED)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pd.DataFrame({n: pd.Series(list(c), dtype=object if k == "binary" else "int64") for (n, k), c in zip(names, columns)})


def _whole_buckets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one bucket after another, from batches sorted by bucket."""
    held: list[pd.DataFrame] = []
    for part in parts:
        for b, rows in part.groupby("b", sort=True):
            if held and held[0]["b"].iloc[0] != b:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held, ignore_index=True)


TOLD = "b int, docs binary, size binary, x binary"
MERGED = "o long, h long, x binary"


def _deal(rows: list[tuple[int, int, bytes]], buckets: int) -> pd.DataFrame:
    """What is found for documents, one row for each bucket of documents."""
    dealt: dict[int, list[tuple[int, int, bytes]]] = {}
    for row in rows:
        dealt.setdefault((row[0] ^ row[1]) % buckets, []).append(row)
    return _frame([
        (b, np.array([(o, h) for o, h, _ in some], "<i8").tobytes(), np.array([len(x) for *_, x in some], "<u4").tobytes(), b"".join(x for *_, x in some))
        for b, some in dealt.items()
    ], TOLD)


def _merge_documents(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each document of a bucket, with all that was found for it."""
    for rows in _whole_buckets(parts):
        found: dict[tuple[int, int], list[bytes]] = {}
        for docs, size, data in zip(rows["docs"], rows["size"], rows["x"]):
            end = np.cumsum(np.frombuffer(size, "<u4"), dtype=np.int64)
            for (o, h), lo, hi in zip(np.frombuffer(docs, "<i8").reshape(-1, 2).tolist(), [0, *end[:-1].tolist()], end.tolist()):
                found.setdefault((o, h), []).append(data[lo:hi])
        yield _frame([(o, h, b"".join(x)) for (o, h), x in found.items()], MERGED)


def _answer(parts: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """For each document the anchors that another document has too."""
    for rows in _whole_buckets(parts):
        ready = rows["own"].isna()
        out = [(o, h, k) for o, h, k in zip(rows["o"][ready], rows["h"][ready], rows["keys"][ready])]
        keys, docs, own, tell, base = [], [], [], [], 0
        for k, d, w, t in rows.loc[~ready, ["keys", "docs", "own", "tell"]].itertuples(index=False):
            keys.append(_unpack(k))
            docs.append(np.frombuffer(d, "<i8").reshape(2, -1))
            own.append(np.cumsum(np.frombuffer(w, "<u2").astype(np.int64)) + base)
            tell.append(np.unpackbits(np.frombuffer(t, np.uint8), count=len(keys[-1])).astype(bool))
            base += docs[-1].shape[1]
        if keys:
            key, table, doc, wait = np.concatenate(keys), np.concatenate(docs, axis=1), np.concatenate(own), np.concatenate(tell)
            order = np.argsort(key)
            ranked = key[order]
            shared = np.zeros(len(key), bool)
            same = ranked[1:] == ranked[:-1]
            shared[order[1:]] |= same
            shared[order[:-1]] |= same
            at = np.flatnonzero(shared & wait)
            if len(at):
                at = at[np.argsort(doc[at], kind="stable")]
                for lo, hi in zip(*_runs(doc[at])):
                    o, h = table[:, doc[at[lo]]]
                    out.append((int(o), int(h), _pack(key[at[lo:hi]])))
        yield _deal(out, buckets)


CHUNKS = "b int, o long, h long, spans binary, size binary, place binary, docs binary, own binary, start binary, bytes binary"


def _send_chunks(parts: Iterator[pd.DataFrame], width: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Chunks at shared anchors for their buckets; of equal ones in a task only the smallest document's."""
    pack = zstandard.ZstdCompressor(level=1)
    for held in _flushes(parts, ["t", "o", "h", "shared"]):
        shared = [np.sort(_unpack(x)) for x in held["shared"]]
        # the first by (id, hash) comes first, so that the first holder of a chunk has the smallest id
        rank = sorted(range(len(shared)), key=lambda i: (held["o"][i], held["h"][i]))
        texts = [held["t"][i] for i in rank]
        o, h = (np.array([held[c][i] for i in rank], np.int64) for c in ("o", "h"))
        first: dict[bytes, int] = {}
        gone: dict[int, list[tuple[int, int]]] = {}
        send: list[tuple[int, int, int, int, bytes]] = []
        for doc, lo, hi, anchor, key in text_chunks(texts, width):
            key &= KEY
            keep = np.zeros(len(doc), bool)
            if len(doc):
                for a, z in zip(*_runs(doc)):
                    want = shared[rank[doc[a]]]
                    at = np.minimum(np.searchsorted(want, key[a:z]), len(want) - 1)
                    keep[a:z] = want[at] == key[a:z]
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            for d, s, e, p, b in zip(doc[keep].tolist(), lo[keep].tolist(), hi[keep].tolist(), (anchor - lo)[keep].tolist(), bucket[keep].tolist()):
                data = texts[d][s : e + width]
                owner = first.setdefault(data, d)
                if o[owner] < o[d]:
                    gone.setdefault(d, []).append((s, e + width))
                else:
                    send.append((b, d, s, p, data))
        rows = [(int(h[d]) % buckets, o[d], h[d], _join_spans(np.array(x, np.int64)).astype("<i8").tobytes(), *[None] * 6) for d, x in gone.items()]
        send.sort(key=lambda x: x[0])
        if send:
            bucket = np.array([x[0] for x in send])
            for lo, hi in zip(*_runs(bucket)):
                some = send[lo:hi]
                table, own = np.unique([x[1] for x in some], return_inverse=True)
                column = lambda i, kind, some=some: np.array([x[i] for x in some], kind).tobytes()
                rows.append((
                    some[0][0], 0, 0, None, np.array([len(x[4]) for x in some], "<u2").tobytes(), column(3, "<u2"),
                    np.stack([o[table], h[table]]).astype("<i8").tobytes(), own.astype("<u2").tobytes(), column(2, "<u4"), pack.compress(b"".join(x[4] for x in some)),
                ))
        yield _frame(rows, CHUNKS)


class SuffixOrder:
    """Comparison of suffixes of one byte string, up to ``width`` bytes, by prefix hashes."""

    def __init__(self, data: np.ndarray, width: int):
        self.data, self.width, self.prefix = data, width, prefix_hashes(data)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the first ``width`` bytes of each pair have one hash."""
        return span_hashes(self.prefix, a, a + self.width) == span_hashes(self.prefix, b, b + self.width)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = span_hashes(self.prefix, a, a + mid) == span_hashes(self.prefix, b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        end = n == self.width
        i = np.where(end, 0, n)
        return ~end & (self.data[a + i] < self.data[b + i])


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number."""
    if len(data) < 8:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view(np.uint64).ravel()


def merge_sort(order: SuffixOrder, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Suffixes ``at`` sorted within each group; ``group`` is ascending. Stable.

    Every level merges all neighbouring runs of all groups: an element goes behind the elements of the
    sibling run that precede it, which a binary search counts.
    """
    at = at.copy()
    start, end = _runs(group)
    size = end - start
    width = 1
    while len(size) and width < size.max():
        big = np.flatnonzero(size > width)
        base = np.repeat(start[big], size[big])
        local = np.arange(len(base)) - np.repeat(np.cumsum(size[big]) - size[big], size[big])
        total = np.repeat(size[big], size[big])
        run = local // width
        low = np.minimum((run ^ 1) * width, total)
        high = np.minimum(low + width, total)
        sibling = low
        own = at[base + local]
        right = run % 2 == 1
        low = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            x, y = own[open_], at[base[open_] + mid]
            late = right[open_]
            # of equals the left run stays first
            less = order.less(np.where(late, x, y), np.where(late, y, x))
            before = np.where(late, ~less, less)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        new = base + (run & ~1) * width + (local - run * width) + (low - sibling)
        at[new] = own
        width *= 2
    return at


def repeated_windows(texts: list[bytes], anchor: np.ndarray, place: np.ndarray, least: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(chunk, first, last)``: runs of windows of distinct chunks that a chunk with a smaller ``least`` has too."""
    size = np.array([len(t) for t in texts], np.int64)
    offset = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts), np.uint8)
    windows = size - width + 1
    chunk = np.repeat(np.arange(len(texts)), windows)
    j = np.arange(len(chunk)) - np.repeat(np.cumsum(windows) - windows, windows)
    suffix = offset[chunk] + j
    word = _words(data)
    # The anchor lies within the window. A key that two lists share by chance makes one list of them, which is sorted all the same.
    key = mix((anchor[chunk] * width + place[chunk] - j).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mix(word[suffix] * np.uint64(0xC2B2AE3D27D4EB4F)))
    key = mix(key ^ word[suffix + width - 8] * np.uint64(0x165667B19E3779F9))
    by = np.argsort(key, kind="stable")
    ranked = key[by]
    start, end = _runs(ranked)
    alone = np.repeat(end - start == 1, end - start)
    by, ranked = by[~alone], ranked[~alone]
    out = np.zeros(len(chunk), bool)
    if len(by):
        order = SuffixOrder(data, width)
        of = np.zeros(len(data) + 1, np.int64)
        of[suffix[by]] = by
        sorted_ = suffix[by]
        pair = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
        same = order.equal(sorted_[pair - 1], sorted_[pair])
        start, end = _runs(ranked)
        lists = np.repeat(np.arange(len(start)), end - start)
        mixed = np.zeros(len(start), bool)
        mixed[lists[pair[~same]]] = True
        mixed = mixed[lists]
        if mixed.any():
            sorted_[mixed] = merge_sort(order, sorted_[mixed], ranked[mixed])
            same = order.equal(sorted_[pair - 1], sorted_[pair])
        equal = np.zeros(len(by), bool)
        like = pair[same]
        for lo in range(0, len(like), 1 << 16):
            some = like[lo : lo + (1 << 16)]
            steps = np.append(np.arange(0, width - 8, 8), width - 8)
            true = (word[sorted_[some - 1][:, None] + steps] == word[sorted_[some][:, None] + steps]).all(axis=1)
            if not true.all():  # two strings with one hash: sort by the bytes themselves
                sorted_ = np.array([p for _, _, p in sorted((g, data[p : p + width].tobytes(), p) for g, p in zip(ranked.tolist(), sorted_.tolist()))])
                equal[:] = False
                text = [data[p : p + width].tobytes() for p in sorted_]
                equal[1:] = [ranked[i] == ranked[i - 1] and text[i] == text[i - 1] for i in range(1, len(text))]
                break
            equal[some] = True
        number = np.cumsum(~equal) - 1
        element = of[sorted_]
        low = np.full(number[-1] + 1, LAST)
        np.minimum.at(low, number, least[chunk[element]])
        out[element] = least[chunk[element]] > low[number]
    at = np.flatnonzero(out)
    if not len(at):
        return at, at, at
    new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(chunk[at]) > 0)])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
    return chunk[at[new]], j[at[new]], j[at[last]]


def _join_spans(spans: np.ndarray) -> np.ndarray:
    """Sorted, overlapping or touching spans as one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[last]], axis=1)


def _join_owned(owner: np.ndarray, spans: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(owner, joined spans)`` of every owner, by one pass over all spans."""
    if not len(owner):
        return
    names, of = np.unique(owner, return_inverse=True)
    room = int(spans[:, 1].max()) + 2  # spans of two owners never touch
    joined = _join_spans(spans + (of * room)[:, None])
    of = joined[:, 0] // room
    joined = joined - (of * room)[:, None]
    for name, lo, hi in zip(names.tolist(), *(x.tolist() for x in _runs(of))):
        yield name, joined[lo:hi]


def _settle(parts: Iterator[pd.DataFrame], width: int, buckets: int) -> Iterator[pd.DataFrame]:
    """The spans that go, by document, from the chunks of whole buckets."""
    unpack = zstandard.ZstdDecompressor()
    for rows in _whole_buckets(parts):
        ready = rows["bytes"].isna()
        out = [(o, h, x) for o, h, x in zip(rows["o"][ready], rows["h"][ready], rows["spans"][ready])]
        texts: dict[bytes, int] = {}
        place, number, doc, start, tables, base = [], [], [], [], [], 0
        for size, p, d, own, s, data in rows.loc[~ready, ["size", "place", "docs", "own", "start", "bytes"]].itertuples(index=False):
            end = np.cumsum(np.frombuffer(size, "<u2"), dtype=np.int64)
            data = unpack.decompress(data)
            for a, z, q in zip(np.concatenate([[0], end[:-1]]).tolist(), end.tolist(), np.frombuffer(p, "<u2").tolist()):
                n = texts.setdefault(data[a:z], len(texts))
                if n == len(place):
                    place.append(q)
                number.append(n)
            tables.append(np.frombuffer(d, "<i8").reshape(2, -1))
            doc.append(np.frombuffer(own, "<u2").astype(np.int64) + base)
            start.append(np.frombuffer(s, "<u4").astype(np.int64))
            base += tables[-1].shape[1]
        if texts:
            table, doc, start, number, place = np.concatenate(tables, axis=1), np.concatenate(doc), np.concatenate(start), np.array(number), np.array(place)
            pure = list(texts)
            least = np.full(len(pure), LAST)
            np.minimum.at(least, number, table[0, doc])
            seeds: dict[bytes, int] = {}
            anchor = np.array([seeds.setdefault(t[q : q + SEED], len(seeds)) for t, q in zip(pure, place.tolist())])
            size = np.array([len(t) for t in pure])
            group = np.argsort(anchor, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(anchor[group])) + 1, len(group))
            weight = np.concatenate([[0], np.cumsum(size[group])])
            reach = weight[edges]
            runs: list[tuple[np.ndarray, ...]] = []
            lo = 0
            while lo < len(group):  # whole anchors, about PART bytes at a time
                fit = np.searchsorted(reach, weight[lo] + PART, side="right") - 1
                hi = int(edges[max(fit, np.searchsorted(edges, lo, side="right"))])
                some = group[lo:hi]
                c, first, last = repeated_windows([pure[i] for i in some], anchor[some], place[some], least[some], width)
                runs.append((some[c], first, last + width))
                lo = hi
            chunk, first, end = (np.concatenate(x) for x in zip(*runs))
            order = np.argsort(chunk, kind="stable")
            first, end = first[order], end[order]
            many = np.bincount(chunk, minlength=len(pure))
            at = np.cumsum(many) - many
            late = table[0, doc] > least[number]
            here = np.flatnonzero(~late & (many[number] > 0))
            each = many[number[here]]
            which = np.repeat(at[number[here]] - np.cumsum(each) + each, each) + np.arange(each.sum())
            here = np.repeat(here, each)
            late = np.flatnonzero(late)
            owner = np.concatenate([doc[late], doc[here]])
            spans = np.stack([np.concatenate([start[late], start[here] + first[which]]), np.concatenate([start[late] + size[number[late]], start[here] + end[which]])], axis=1)
            for at, some in _join_owned(owner, spans):
                out.append((int(table[0, at]), int(table[1, at]), some.astype("<i8").tobytes()))
        yield _deal(out, buckets)


def _spans(data: bytes | None) -> np.ndarray:
    spans = np.frombuffer(data or b"", "<i8").reshape(-1, 2)
    return _join_spans(spans) if len(spans) else spans


def with_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` with ``t`` (text), ``o`` (id), ``h`` and ``gone`` (pairs of 64-bit places), other columns renamed.

    Returns the frame and its names of the original columns but the text. Texts are shuffled once, by
    (id, hash), and both joins read that one exchange.
    """
    if width <= SEED:
        raise ValueError(f"width must be over {SEED}")
    others = [c for c in docs.columns if c != text_col]
    names = [f"c{i}" for i in range(len(others))]
    base = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(others, names)], whole_text(F.col(f"`{text_col}`")).alias("t"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("o"),
    ).withColumn("h", F.xxhash64("t"))
    parts = partitions(docs)
    texts = base.repartition(parts, "o", "h")
    gather = lambda rows: rows.repartition(parts, "b").sortWithinPartitions("b")
    asked = base.select("t", "o", "h").mapInPandas(lambda rows: _ask(rows, width, parts), ASKED)
    told = gather(asked).mapInPandas(lambda rows: _answer(rows, parts), TOLD)
    shared = gather(told).mapInPandas(_merge_documents, MERGED).withColumnRenamed("x", "shared")
    met = texts.join(shared.hint("shuffle_hash"), ["o", "h"])
    sent = met.mapInPandas(lambda rows: _send_chunks(rows, width, parts), CHUNKS)
    spans = gather(sent).mapInPandas(lambda rows: _settle(rows, width, parts), TOLD)
    spans = gather(spans).mapInPandas(_merge_documents, MERGED).withColumnRenamed("x", "gone")
    return texts.join(spans.hint("shuffle_hash"), ["o", "h"], "left"), names


def repeat_digests(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row.

    Texts are UTF-8 bytes, null ones empty; texts under ``width`` bytes lose nothing. A null id counts as
    larger than all others and stays null (the largest long is reserved for it). Repeated ids are
    not smaller than each other, so their rows keep what only they share; rows that repeat id and text
    agree. Further columns are not read; an empty table gives no rows.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text, o, found in zip(part["t"], part["o"], part["gone"]):
                data, spans = text.encode("utf-8", "surrogatepass"), _spans(found)
                keep, at = hashlib.sha256(), 0
                for s, e in spans.tolist():
                    keep.update(data[at:s])
                    at = e
                keep.update(data[at:])
                rows.append((o, len(data), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), keep.hexdigest()))
            yield pd.DataFrame(rows, columns=["o", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    frame, _ = with_repeats(docs.select(F.col(id_col), F.col(text_col)), width, id_col, text_col)
    out = frame.mapInPandas(run, "o long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("o") != LAST, F.col("o")).alias(id_col), *out.columns[1:])


def cut_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated bytes, all columns kept.

    A character stays whole unless all its bytes go. Null texts become empty; else as :func:`repeat_digests`.
    """
    frame, names = with_repeats(docs, width, id_col, text_col)

    @F.pandas_udf("string")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, gone in parts:
            out = []
            for text, found in zip(texts, gone):
                spans = _spans(found)
                if len(spans):
                    data = text.encode("utf-8", "surrogatepass")
                    raw = np.frombuffer(data, np.uint8)
                    begins = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(data))
                    s = begins[np.searchsorted(begins, spans[:, 0])]
                    e = begins[np.searchsorted(begins, spans[:, 1], side="right") - 1]
                    edges = [0, *np.stack([s, np.maximum(s, e)], axis=1).ravel().tolist(), len(data)]
                    text = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode("utf-8", "surrogatepass")
                out.append(text)
            yield pd.Series(out, dtype=object)

    back = dict(zip([c for c in docs.columns if c != text_col], names))
    return frame.select(*[cut("t", "gone").alias(c) if c == text_col else F.col(back[c]).alias(c) for c in docs.columns])
