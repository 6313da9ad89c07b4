"""Nearest neighbours, syncmers and revisits against brute force."""

import datetime
import functools
import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from featureloom.llm import ann, syncmers, warc

IS_QUERY = lambda i: i % 20 == 0


def brute(ids, x, queries, top=20):
    out = {}
    for q in queries:
        score = x @ x[ids.index(q)]
        order = sorted((k for k in range(len(ids)) if ids[k] != q), key=lambda k: (-score[k], ids[k]))[:top]
        out[q] = [(ids[k], score[k]) for k in order]
    return out


def rows_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = vectors.orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    got = rows_of(ann.nearest(vectors, IS_QUERY))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9
    place = {i: k for k, i in enumerate(ids)}
    for q, hits in got.items():
        assert np.allclose([s for _, s in hits], [x[place[v]] @ x[place[q]] for v, _ in hits], rtol=0, atol=1e-12)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))


@pytest.mark.parametrize("shard", [8192, 7])
def test_all_lists_with_different_norms(spark, monkeypatch, shard):
    """With every list probed and no test, the result is exact, however lists are cut."""
    monkeypatch.setattr(ann, "SHARD", shard)
    monkeypatch.setattr(ann, "QUERIES", 3)
    monkeypatch.setattr(ann, "EPSILON", 1e9)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((160, 9)) * rng.uniform(0.1, 5, (160, 1))
    x[40:60] = x[40]  # ties
    data = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, score int")
    got = rows_of(ann.nearest(data, IS_QUERY, share=1.0))
    want = brute(list(range(160)), x, range(0, 160, 20))
    for q in want:
        assert [a for a, _ in got[q]] == [a for a, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, [1.0]), (None, [1.0, 1.0]), (5, [2.0, 1.0]), (6, [2.0, 1.0]), (6, [2.0, 1.0]), (60, [0.5, 0.5]), (7, [])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(ann.nearest(data, IS_QUERY))
    assert got == {0: [(5, 2.0), (6, 2.0), (60, 0.5)], 60: [(5, 1.5), (6, 1.5), (0, 0.5)]}
    assert ann.nearest(data.limit(0), IS_QUERY).count() == 0
    assert ann.nearest(data.where("vec_id = 0"), IS_QUERY).count() == 0


def words_of(text):
    return re.findall(r"[぀-ヿ㐀-鿿]|[^ \t\n\x0b\f\r぀-ヿ㐀-鿿]{1,24}", text)


def test_syncmers_are_closed_and_context_free(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 5, 6, 7, 60, 200)] + ["同じ文字 in a text with wordsofmorethantwentyfourcharacters", None]
    shared = texts[5]
    texts += ["other words before " + shared, shared + " and other words behind"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("at", F.lit(0))
    got = {r.doc_id: [(s["at"], s["hash"]) for s in r.syncmers] for r in syncmers.with_syncmers(rows).collect()}
    hashed = lambda df: df.select("k", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h"))
    pairs = sorted({(a, b) for t in texts for w in [words_of(t or "")] for a, b in zip(w, w[1:])})
    table = spark.createDataFrame([(f"{a} {b}", a, b) for a, b in pairs], "k string, a string, b string")
    smer = {r.k: r.h for r in hashed(table).collect()}
    for k, t in enumerate(texts):
        w = words_of(t or "")
        s = [smer[f"{a} {b}"] for a, b in zip(w, w[1:])]
        span = syncmers.SPAN
        want = [i for i in range(len(s) - span + 1) if min(s[i : i + span]) in (s[i], s[i + span - 1])]
        assert [at for at, _ in got[k]] == want
    of = lambda k: {h for _, h in got[k]}
    assert of(5) <= of(len(texts) - 2) and of(5) <= of(len(texts) - 1)
    moved = dict((h, at) for at, h in got[len(texts) - 2])
    assert {moved[h] - at for at, h in got[5]} == {3}


def test_edited_texts_and_neighbours(spark):
    rng = random.Random(6)
    rows = [(i * 3, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(1, None), (2, ""), (4, "ééé 😀 x"), (500, "one two three"), (501, "one two three"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("f", F.lit("x")).withColumn("o", F.lit(1))
    out = syncmers.edited_fingerprints(docs)
    got = {r.doc_id: r for r in out.collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[500].fingerprint == got[501].fingerprint != "" and got[500].near_next == 1.0
    assert got[1].fingerprint == got[2].fingerprint == "" and got[1].near_next == 1.0
    sketch = lambda r: {r.fingerprint[j : j + 8] for j in range(0, len(r.fingerprint), 8)}
    for k in range(len(ordered)):
        a, b = sketch(got[ordered[k][0]]), sketch(got[ordered[(k + 1) % len(ordered)][0]])
        least = set(sorted(a | b)[: syncmers.SIZE])
        assert np.isclose(got[ordered[k][0]].near_next, len(a & b & least) / len(least) if least else 1.0)
    assert syncmers.edited_fingerprints(docs.limit(0)).count() == 0
    alone = syncmers.edited_fingerprints(docs.where("doc_id = 4")).first()
    assert alone.near_next == 1.0


def test_repeated_ids_share_their_next_document(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "short"), (2, "u v w x y z")], "doc_id long, text string")
    got = syncmers.edited_fingerprints(docs).collect()
    assert len(got) == 4
    want = {hashlib.sha256(t.encode()).hexdigest() for t in ("a b c d u v w x", "shou ")}
    assert {r.edited_sha256 for r in got if r.doc_id == 1} == want


def test_many_texts_of_one_id_and_of_none(spark):
    rng = random.Random(12)
    text = lambda: " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(0, 60)))
    rows = [(None, text()) for _ in range(120)] + [(7, text()) for _ in range(150)] + [(i, text()) for i in range(10, 30)] + [(30, text())] * 3
    rows += rng.sample(rows, 40)
    got = syncmers.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t)
    order = sorted(texts, key=lambda i: (i is not None, i or 0))
    first = {r.doc_id: r for r in sorted(got, key=lambda r: -r.text_hash)}  # of each id the text with the least hash
    hashed = spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).distinct().collect()
    by_hash = {r.h: r.t for r in hashed}
    want = []
    for i, t in rows:
        nxt = by_hash[first[order[(order.index(i) + 1) % len(order)]].text_hash]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        want.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(want) == sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got)


def test_fingerprints_against_plain_syncmers(spark):
    rng = random.Random(13)
    texts = [" ".join(f"w{rng.randrange(400)}" + "x" * rng.choice([0, 0, 0, 30]) for _ in range(rng.choice([0, 3, 7, 12, 60, 900]))) for _ in range(60)]
    hashed = lambda values: functools.reduce(lambda seed, v: xxhash.xxh64_intdigest(struct.pack("<Q", v), seed), values, 42)
    signed = lambda v: v - (v >> 63 << 64)

    def plain(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"\S{1,24}", text)]
        s = [hashed(h[i : i + 2]) for i in range(len(h) - 1)]
        some = set()
        for i in range(len(s) - syncmers.SPAN + 1):
            inner = s[i : i + syncmers.SPAN]
            if min(inner, key=signed) in (inner[0], inner[-1]):
                some.add(hashed(inner) >> 33)
        if not some and h:
            some = {hashed(h) >> 33}
        return "".join(f"{x:08x}" for x in sorted(some)[: syncmers.SIZE])

    got = {r.doc_id: r.fingerprint for r in syncmers.edited_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert any(len(f) == 8 * syncmers.SIZE for f in got.values())


def test_short_texts_without_syncmers_have_a_fingerprint(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (6, 7, 8) for _ in range(20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bare = {r.doc_id for r in syncmers.with_syncmers(rows).where("size(syncmers) = 0").collect()}
    assert {len(texts[i].split()) for i in bare} == {6, 7, 8}
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(rows).collect()}
    assert all(r.fingerprint and r.edited_fingerprint and r.near_next == 0 for r in got.values())
    assert len({got[i].fingerprint for i in bare}) == len(bare)


def test_canonical_urls(spark):
    same = ["http://www.Example.com:80/a/?b=2&utm_source=x&a=1#top", "https://example.com/a?a=1&b=2", " HTTPS://user@EXAMPLE.com:443/a/?ref=q&a=1&b=2"]
    other = ["https://example.com/A?a=1&b=2", "https://example.com", "no url", "", None, "http://"]
    df = spark.createDataFrame([(u,) for u in same + other], "u string")
    got = [r[0] for r in df.select(warc.canonical_url(F.col("u"))).collect()]
    assert got == ["example.com/a?a=1&b=2"] * 3 + ["example.com/A?a=1&b=2", "example.com", None, None, None, None]


def record(i, url, hour, status, headers=None, digest=None):
    day = None if hour is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour)
    return (i, url, day, status, headers, digest, "extra")


SCHEMA = "record_id long, url string, date timestamp, status int, headers map<string,string>, digest string, carried string"


@pytest.mark.parametrize("seconds", [3600, 10**9])
def test_revisits(spark, seconds):
    u = "http://a.org/x"
    records = [
        record(1, u, 0, 200, {"ETag": '"1"', "Content-Length": "5", "Cache-Control": "no"}, "d1"),
        record(2, u, 50, 200, {"ETag": '"2"', "etag": '"zz"', "Last-Modified": "m"}, "d2"),
        record(3, u, 60, 404, {"ETag": '"3"'}, "d3"),
        record(10, "https://www.a.org/x#f", 1, 304, {"etag": 'W/"1"', "Content-Length": "0", "CACHE-CONTROL": "yes", "X": "y"}),
        record(11, u, 51, 304, {"etag": '"1"'}),
        record(12, u, 70, 304, {"last-modified": "m"}),
        record(13, u, 70, 304, None),
        record(14, u, -1, 304, {"etag": '"1"'}),
        record(15, None, 5, 304, None),
        record(16, "http://b.org", 5, 304, None),
        record(17, u, None, 304, None),
        record(2, u, 50, 304, {"etag": '"1"'}),  # as late as a response with its own id: that is not earlier
    ]
    got = warc.resolve_revisits(spark.createDataFrame(records, SCHEMA), seconds).collect()
    by = {(r.record_id): (r.outcome, r.refers_to, r.digest) for r in got}
    assert by == {
        10: ("resolved", 1, "d1"), 11: ("changed", 2, None), 12: ("resolved", 2, "d2"), 13: ("unvalidated", 2, "d2"),
        14: ("no_response", None, None), 15: ("no_url", None, None), 16: ("no_response", None, None), 17: ("no_response", None, None),
        2: ("resolved", 1, "d1"),
    }
    merged = next(r.headers for r in got if r.record_id == 10)
    assert merged == {"etag": 'W/"1"', "content-length": "5", "cache-control": "yes"}
    assert warc.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_records_of_one_url_against_brute_force(spark):
    rng = random.Random(1)
    records = [record(i, "http://a.org", rng.randrange(300), rng.choice([200, 304, 304]), {"etag": rng.choice("ab")}, f"d{i}") for i in range(400)]
    got = {r.record_id: (r.refers_to, r.outcome) for r in warc.resolve_revisits(spark.createDataFrame(records, SCHEMA), 7200).collect()}
    full = sorted((r[2], r[0], r[4]["etag"]) for r in records if r[3] == 200)
    for r in records:
        if r[3] == 304:
            before = [f for f in full if (f[0], f[1]) < (r[2], r[0])]
            want = (before[-1][1], "resolved" if before[-1][2] == r[4]["etag"] else "changed") if before else (None, "no_response")
            assert got[r[0]] == want
