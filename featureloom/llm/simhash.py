"""SimHash fingerprints linked through a byte-position inverted index.

Two 64-bit fingerprints with at most 4 differing bits agree in at least 4 of their 8 positional
bytes. The index enters every distinct fingerprint under sets of three positional bytes,
chosen so that any 4 of the 8 positions contain one of the sets (20 sets do). Fingerprints that
meet on a list have the positional bytes they share tallied; pairs with the guaranteed 4 are
verified bit by bit. Keys of three bytes instead of one keep the lists 65,536 times shorter; the
pairs that pass are the same.

A list hands on a spanning forest of its links, never all its pairs. Lists of over ``BLOCK``
fingerprints are cut into blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureloom.llm.components import connected_components
from featureloom.llm.shared import LAST, partitions, staged, whole_text

BLOCK = 4096
NEAR = 8  # longest list whose pairs are compared without a loop
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, repeats included (no word: 0)."""
    tokens = text.encode().lower().split()  # of bytes: A-Z only, blanks 0x20 and 0x09 to 0x0D
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    width = min(words, len(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(tokens) - width + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist())), np.uint64, n)
    columns = hashes.view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(columns[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, words: int = 4) -> Column:
    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(np.array([fingerprint(t, words) for t in part], np.uint64).view(np.int64))

    return run(whole_text(text))


def position_sets() -> list[tuple[int, int, int]]:
    """Triples of the 8 byte positions such that any 4 positions contain one.

    Three parts of 3, 3 and 2 positions: triples within a part, or two of a part and one of the next.
    """
    part = [0, 0, 0, 1, 1, 1, 2, 2]
    good = []
    for t in combinations(range(8), 3):
        count = [sum(part[p] == k for p in t) for k in range(3)]
        if 3 in count or any(count[k] == 2 and count[(k + 1) % 3] == 1 for k in range(3)):
            good.append(t)
    return good


def _links(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs share enough positional bytes and then differ in few enough bits."""
    diff = x ^ y
    enough = (diff.reshape(-1, 1).view(np.uint8) == 0).sum(axis=1) >= 8 - distance
    enough[enough] = np.bitwise_count(diff[enough]) <= distance
    return enough


def list_forest(fps: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links of one list that connect what its pairs connect: at most one less than fingerprints."""
    label = np.arange(len(fps))
    a, b = [], []
    for i in range(1, len(fps)):
        hit = np.flatnonzero(_links(fps[:i], np.broadcast_to(fps[i], i), distance))
        if not len(hit):
            continue
        groups, first = np.unique(label[hit], return_index=True)
        a += [i] * len(groups)
        b += hit[first].tolist()
        label[i] = groups[0]
        if len(groups) > 1:
            label[:i][np.isin(label[:i], groups[1:])] = groups[0]
    return a, b


def _partition_links(parts: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Links from rows sorted by list; a list may run over the edge of a batch."""
    keep: pd.DataFrame | None = None

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        g = rows[["k", "lo", "hi"]].to_numpy()
        fps = rows["fp"].to_numpy().view(np.uint64)
        head = np.ones(len(g), bool)
        head[1:] = (g[1:] != g[:-1]).any(axis=1)
        number = np.cumsum(head) - 1
        size = np.bincount(number)
        short = size[number] <= NEAR
        a, b = [], []
        for d in range(1, NEAR):
            i = np.flatnonzero((number[d:] == number[:-d]) & short[d:])
            if not len(i):
                break
            i = i[_links(fps[i], fps[i + d], distance)]
            a.append(fps[i])
            b.append(fps[i + d])
        starts = np.flatnonzero(head)
        for s, n in zip(starts[size > NEAR].tolist(), size[size > NEAR].tolist()):
            own = fps[s : s + n]
            x, y = list_forest(own, distance)
            a.append(own[x])
            b.append(own[y])
        none = [np.zeros(0, np.uint64)]
        out = pd.DataFrame({"a": np.concatenate(a or none).view(np.int64), "b": np.concatenate(b or none).view(np.int64)})
        return out.drop_duplicates()

    for part in parts:
        rows = part if keep is None else pd.concat([keep, part], ignore_index=True)
        if not len(rows):
            continue
        last = rows[["k", "lo", "hi"]].to_numpy()
        same = (last == last[-1]).all(axis=1)
        cut = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
        keep = rows.iloc[cut:]
        if cut:
            yield work(rows.iloc[:cut])
    if keep is not None and len(keep):
        yield work(keep)


def fingerprint_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that connect all within ``distance`` bits."""
    if not 0 <= distance <= 4:
        raise ValueError("the index guarantees distances up to 4")
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = [
        F.lit(n << 24).cast("long").bitwiseOR(F.shiftleft(byte[i], 16)).bitwiseOR(F.shiftleft(byte[j], 8)).bitwiseOR(byte[k])
        for n, (i, j, k) in enumerate(position_sets())
    ]
    entries = fps.select("fp", F.explode(F.array(*keys)).alias("k"))
    long = entries.groupBy("k").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    long = long.select("k", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    entries = entries.join(long, "k", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    entries = entries.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = entries.select("k", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    met = met.repartition(partitions(fps), "k", "lo", "hi").sortWithinPartitions("k", "lo", "hi")
    return met.mapInPandas(lambda parts: _partition_links(parts, distance), "a long, b long")


def simhash_components(
    docs: DataFrame, distance: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, text_hash, fp, root, component_id)``, one row for each input row.

    ``fp`` is the fingerprint, ``root`` the least fingerprint (signed) of its component,
    ``component_id`` the smallest id there (null where all are null), ``text_hash`` tells rows
    with one id apart. Null and empty texts have fingerprint zero and link like others; texts of
    fewer than ``words`` words are one shingle; repeated rows stay; further columns are not read;
    an empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("i"), whole_text(text_col).alias("t"))
    signed = staged(slim.select("i", F.xxhash64("t").alias("text_hash"), fingerprint_column(F.col("t"), words).alias("fp")), "fingerprints")
    fps = staged(signed.groupBy("fp").agg(F.min("i").alias("low")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(fps.select("fp"), distance))
    known = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(least, "root").select("fp", "root", "component_id")
    out = signed.join(known, "fp").select("i", "text_hash", "fp", "root", "component_id")
    return out.withColumnRenamed("i", id_col)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, distance: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of :func:`simhash_components`, all columns kept.

    The row with the smallest id (a null id comes last), of those the one with the least text hash;
    of rows that agree in both one is left.
    """
    found = simhash_components(docs, distance, words, id_col, text_col)
    order = F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("o"), F.col("text_hash").alias("h"))
    keep = found.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.o").alias("__o"), F.col("k.h").alias("__h"))
    keyed = docs.withColumn("__o", F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))).withColumn("__h", F.xxhash64(whole_text(text_col)))
    return keyed.join(keep, ["__o", "__h"], "left_semi").dropDuplicates(["__o", "__h"]).drop("__o", "__h")
