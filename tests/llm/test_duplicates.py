"""Suffix-sort dedup and SimHash against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from featureloom.llm import simhash, suffixes
from featureloom.llm.components import connected_components
from featureloom.llm.shared import LAST


def masks(rows, width=50):
    """The bytes that go, text by text."""
    low = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            low[b[p : p + width]] = min(low.get(b[p : p + width], LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1):
            if low[b[p : p + width]] < (LAST if i is None else i):
                gone[p : p + width] = True
        out.append((i, b, gone))
    return out


def digests(rows, width=50):
    out = []
    for i, b, gone in masks(rows, width):
        edge = np.concatenate([[False], gone])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int((edge[1:] & ~edge[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(n=120, seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é") for _ in range(300)) for _ in range(5)]
    rows = [(None, base[0]), (None, base[1][:80]), (7, None), (8, ""), (9, "short")]
    for k in range(n):
        x, b = rng.random(), rng.choice(base)
        if x < 0.12:
            t = "a" * rng.randint(40, 200)
        elif x < 0.3:
            t = b
        elif x < 0.85:
            t = b[rng.randint(0, 150) : rng.randint(150, 300)] + rng.choice(base)[rng.randint(0, 150) :]
        else:
            t = "".join(rng.choice("ab") for _ in range(400))
        rows.append((k // 2 if k < 20 else k, t))
    return rows


def frame(spark, rows):
    # names that the operator uses inside, too
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("o", F.lit("x")).withColumn("gone", F.lit(1))


def test_removed_bytes(spark):
    rows = texts()
    got = sorted(map(tuple, suffixes.repeat_digests(frame(spark, rows)).collect()), key=repr)
    assert got == digests(rows)


def test_small_parts_and_flushes_change_nothing(monkeypatch):
    """The task functions themselves, with texts longer than a part and many flushes."""
    import pandas as pd

    monkeypatch.setattr(suffixes, "PART", 150)
    rows = [(i, t) for i, t in texts(60, 5) if i is not None and t]
    rows = list({i: (i, t) for i, t in rows}.values())

    def run(flush):
        monkeypatch.setattr(suffixes, "FLUSH", flush)
        table = pd.DataFrame({"t": [t for _, t in rows], "o": [i for i, _ in rows], "h": [i * 17 for i, _ in rows]})
        asked = pd.concat(list(suffixes._ask(iter([table]), 50, 3))).sort_values("b", kind="stable")
        told = pd.concat(list(suffixes._answer(iter([asked]), 3))).sort_values("b", kind="stable")
        shared = pd.concat(list(suffixes._merge_documents(iter([told])))).rename(columns={"x": "shared"})
        sent = pd.concat(list(suffixes._send_chunks(iter([table.merge(shared, on=["o", "h"])]), 50, 3))).sort_values("b", kind="stable")
        spans = pd.concat(list(suffixes._settle(iter([sent]), 50, 3))).sort_values("b", kind="stable")
        merged = pd.concat(list(suffixes._merge_documents(iter([spans]))))
        return {o: suffixes._spans(x).tolist() for o, x in zip(merged["o"], merged["x"])}

    want = {}
    for i, _, gone in masks(rows):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        if len(edge):
            want[i] = edge.reshape(-1, 2).tolist()
    assert run(1 << 30) == want
    assert run(400) == want


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    """A hash that tells nothing must not change what is found."""
    chunks = [bytes([97 + (i * k) % 5 for i in range(60)]) for k in (1, 2, 3)] + [bytes([97 + i % 5 for i in range(60)])]
    args = (chunks, np.zeros(4, int), np.zeros(4, int), np.array([3, 2, 1, 9]), 50)
    want = [x.tolist() for x in suffixes.repeated_windows(*args)]
    assert want == [[3], [0], [10]]
    monkeypatch.setattr(suffixes, "span_hashes", lambda prefix, a, b: np.zeros(len(a), np.uint64))
    assert [x.tolist() for x in suffixes.repeated_windows(*args)] == want


def test_windows_that_occur_once_or_are_all_equal_are_not_sorted(monkeypatch):
    """One line in many surroundings: its windows are compared with their neighbours, not merged level by level."""
    rng = random.Random(4)
    line = bytes(rng.randrange(97, 123) for _ in range(64))
    chunks = [bytes(rng.randrange(97, 123) for _ in range(20)) + line + bytes(rng.randrange(97, 123) for _ in range(16)) for _ in range(300)]
    looked, hashes = [], suffixes.span_hashes
    monkeypatch.setattr(suffixes, "span_hashes", lambda prefix, a, b: looked.append(len(a)) or hashes(prefix, a, b))
    least = np.arange(300)[::-1].copy()
    # The anchor stands at place 40, in the middle of the line; windows reach from 10 bytes before it.
    got = suffixes.repeated_windows([c[10:90] for c in chunks], np.zeros(300, int), np.full(300, 30), least, 50)
    text = [c[10:90] for c in chunks]
    first = {}
    for i, t in enumerate(text):
        for p in range(31):
            first.setdefault(t[p : p + 50], []).append(i)
    want = sorted((i, p) for i, t in enumerate(text) for p in range(31) if least[i] > min(least[k] for k in first[t[p : p + 50]]))
    assert sorted((int(c), w) for c, a, z in zip(*got) for w in range(a, z + 1)) == want and len(want) > 299
    assert sum(looked) <= 2 * 300 * 31


def test_spans_of_all_owners_are_joined_at_once():
    owner = np.array([5, 2, 5, 2, 5, 9])
    spans = np.array([[0, 60], [10, 70], [60, 110], [100, 150], [200, 250], [0, 50]])
    got = {o: x.tolist() for o, x in suffixes._join_owned(owner, spans)}
    assert got == {2: [[10, 70], [100, 150]], 5: [[0, 110], [200, 250]], 9: [[0, 50]]}


def test_mergesort_sorts_suffixes_in_groups():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    at = rng.permutation(340)
    group = np.sort(rng.integers(0, 5, len(at)))
    got = suffixes.merge_sort(suffixes.SuffixOrder(data, 50), at, group)
    text = data.tobytes()
    for g in range(5):
        own = [text[p : p + 50] for p in got[group == g]]
        assert own == sorted(own) and sorted(got[group == g]) == sorted(at[group == g])


def test_cut_texts_keep_columns_and_characters(spark):
    rows = texts(40, 9)
    docs = frame(spark, rows)
    out = suffixes.cut_repeats(docs)
    assert out.columns == docs.columns
    want = []
    for i, b, gone in masks(rows):
        t, kept, p = b.decode(), "", 0
        for c in t:
            n = len(c.encode())
            kept += "" if gone[p : p + n].all() else c
            p += n
        want.append((i, kept))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert suffixes.cut_repeats(docs.limit(0)).count() == 0
    assert suffixes.repeat_digests(docs.limit(0)).count() == 0


def test_width_must_hold_an_anchor(spark):
    with pytest.raises(ValueError):
        suffixes.repeat_digests(frame(spark, [(1, "a")]), width=20)


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance=4):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_fingerprints():
    for t in ["", " \t\n", "One", "a b c d", "É É É x Y z\x0bq", "The same words the same words the same words"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_hash_is_that_of_spark(spark):
    t = "any shingle of words é"
    assert spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(t.encode(), 42)


def test_any_four_positions_hold_a_set():
    sets = simhash.position_sets()
    assert len(sets) == 20
    assert all(any(set(s) <= set(four) for s in sets) for four in combinations(range(8), 4))


@pytest.mark.parametrize("block", [4096, 6])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, block):
    rng = random.Random(2)
    centre = [rng.getrandbits(64) for _ in range(30)]
    fps = {0}
    for c in centre[:4]:
        for _ in range(25):  # chains around a centre
            x = c
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps | set(centre))
    monkeypatch.setattr(simhash, "BLOCK", block)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    roots = {r.node: r.root for r in connected_components(links).collect()}
    want = components(fps)
    same = lambda of: sorted(sorted(i for i in range(len(fps)) if of[i] == r) for r in set(of))
    assert same([roots.get(x, x) for x in signed]) == same(want)


def test_documents_and_one_of_each(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, " "), (None, "a b"), (1003, "a b"), (1003, "a b")], "doc_id long, text string")
    docs = docs.union(odd).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(0))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows.sort(key=lambda r: LAST if r[0] is None else r[0])
    fps = [plain_fingerprint(t) for _, t in rows]
    root = components(fps)
    got = simhash.simhash_components(docs).collect()
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=repr) == sorted(
        ((i, f, rows[k][0]) for (i, _), f, k in zip(rows, fps, root)), key=repr
    )
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(rows[k][0] for k in set(root))
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(None, 1), (5, 5)]
    known = [(a, b) for a, b in edges if a is not None]
    parent = {x: x for e in known for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in known:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in known if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
