"""Task-side helper for token runs: the bits of all runs of a row, without a row or a text for each run.

The functions here travel to the Python workers by value, so that the workers need no copy
of this package.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Pieces that are digested at once, and tokens and rows in one pass over them.
STEP, TOKENS, ROWS = 1 << 14, 1 << 16, 1 << 10

_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2**32).astype(np.uint32)
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# By the bytes of a piece that are left for four places, from -1 to 4: which of them count, and the mark behind the last.
_KEPT = np.array([0, 0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_MARK = np.array([0, 0x80, 0x8000, 0x800000, 0x80000000, 0], np.uint32)


def md5_columns(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The md5 of every piece of ``text`` as four columns of little-endian 32-bit numbers."""
    ahead = np.concatenate([text, np.zeros(4, np.uint8)]).astype(np.uint32)
    n = len(text)
    four = ahead[:n + 1] | ahead[1:n + 2] << 8 | np.append(ahead[2:], np.uint32(0))[:n + 1] << 16 | np.append(ahead[3:], np.zeros(2, np.uint32))[:n + 1] << 24
    blocks, out = (size + 8) // 64 + 1, np.empty((4, len(start)), np.uint32)
    for count in np.unique(blocks).tolist():
        rows = np.flatnonzero(blocks == count)
        for at in range(0, len(rows), STEP):
            some = rows[at : at + STEP]
            out[:, some] = _md5(four, start[some], size[some], count)
    return out


def _md5(four: np.ndarray, start: np.ndarray, size: np.ndarray, blocks: int) -> tuple[np.ndarray, ...]:
    state = tuple(np.full(len(start), v, np.uint32) for v in _START)
    longest, none = int(size.max()), np.zeros(len(start), np.uint32)
    for block in range(blocks):
        m = []
        for place in range(64 * block, 64 * block + 64, 4):
            if place > longest:
                m.append(none)
                continue
            left = np.clip(size - place, -1, 4) + 1
            m.append(four[np.minimum(start + place, len(four) - 1)] & _KEPT[left] | _MARK[left])
        if block == blocks - 1:
            m[14], m[15] = (size << 3).astype(np.uint32), (size >> 29).astype(np.uint32)
        a, b, c, d = state
        for i in range(64):
            if i < 16:
                f, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, g = c ^ (b | ~d), 7 * i % 16
            f += a
            f += _SINES[i]
            f += m[g]
            turn = _TURNS[i // 16][i % 4]
            turned = f << turn
            turned |= f >> (32 - turn)
            turned += b
            a, b, c, d = d, turned, b, c
        state = tuple(x + y for x, y in zip(state, (a, b, c, d)))
    return state


def run_bits(min_n: int, max_n: int, n_bits: int, per_run: int, sep: str):
    """Task function: arrays of tokens in, 64-bit words with the bits of all their runs of ``min_n..max_n`` tokens out.

    A run is a piece of the tokens written one behind the other, so no run is built. As in ``concat_ws``, null tokens take a
    place in a run and leave no text; a run of one null token is none.
    """
    width = (n_bits + 63) // 64 * 64

    def some(tokens: pa.Array) -> np.ndarray:
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flags = np.zeros(len(sizes) * width, bool)
        values = tokens.flatten().cast(pa.large_string())
        if len(values):
            joined = pc.binary_join_element_wise(values, pa.scalar("", values.type), pa.scalar(sep, values.type))
            offsets = np.frombuffer(joined.buffers()[1], np.int64, len(values) + 1)
            text = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: offsets[-1]]
            first, last = offsets[:-1], offsets[1:] - len(sep.encode())
            row = np.repeat(np.arange(len(sizes)), sizes)
            room = np.cumsum(sizes)[row] - np.arange(len(values))
            heads = [np.flatnonzero(room >= n) for n in range(min_n, max_n + 1)]
            if min_n == 1:
                heads[0] = heads[0][values.is_valid().to_numpy(zero_copy_only=False)[heads[0]]]
            start = np.concatenate([first[h] for h in heads])
            stop = np.concatenate([last[h + n - 1] for n, h in enumerate(heads, min_n)])
            at = np.concatenate([row[h] for h in heads]) * width
            for column in md5_columns(text, start, np.maximum(stop - start, 0))[:per_run]:
                flags[at + column.byteswap() % np.uint32(n_bits)] = True
        return np.packbits(flags.reshape(len(sizes), width), axis=1, bitorder="little").view("<i8")

    def run(tokens: pa.Array) -> pa.Array:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        found, lo = [np.zeros((0, width // 64), np.int64)], 0
        while lo < len(tokens):
            before = ends[lo - 1] if lo else 0
            hi = min(max(int(np.searchsorted(ends, before + TOKENS, "right")), lo + 1), lo + ROWS)
            found.append(some(tokens.slice(lo, hi - lo)))
            lo = hi
        words = np.concatenate(found)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * (width // 64), pa.int32()), pa.array(words.ravel()))

    return run


# Workers may run without this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
