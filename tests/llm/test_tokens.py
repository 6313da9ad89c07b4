"""BPE and packing against the tokenizers library."""

import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from featureloom.llm import bpe, packing
from featureloom.llm.text import cut_text

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def odd_texts(n=1500):
    rng = random.Random(1)
    signs = "ab 's're'll'VE'\n\t  éÉßΣ 12½٣ <|endoftext|>中文aaaa!!&& İ \x1c\x85😀<|startoftext|>'"
    parts = ["'s", "'re", "'ll", " ", "  ", "a", "'", "!", "1", "\n", "<|endoftext|>"]
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(n)]
    return [*out, "", "a" * 700, " ", "\n", "x" * 65 + " " + "x" * 66, "word " * 3000]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_those_of_the_library(path):
    texts, model, library = odd_texts(), bpe.PairIndexBPE(path), Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in model.encode(texts)] == want
    assert [x.tolist() for x in model.encode(texts)] == want  # from the cache


def test_decoding_is_that_of_the_library():
    texts, model, library = odd_texts(300), bpe.PairIndexBPE(WORD), Tokenizer.from_file(WORD)
    for ids in model.encode(texts):
        assert model.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_full_cache_starts_again():
    model = bpe.PairIndexBPE(WORD)
    model.cache.limit = 10
    texts = odd_texts(50)
    assert [x.tolist() for x in model.encode(texts)] == [x.tolist() for x in bpe.PairIndexBPE(WORD).encode(texts)]
    assert model.cache.full() and len(model.encode(["a few other words"])[0])


def test_long_texts_are_cut_where_no_piece_goes_on():
    text = " ".join(odd_texts(40)) * 3
    assert "".join(cut_text(text, 500)) == text and len(cut_text(text, 500)) > 5
    library = Tokenizer.from_file(BYTE)
    whole = library.encode(text.replace("<|endoftext|>", ""), add_special_tokens=False).ids
    parts = cut_text(text.replace("<|endoftext|>", ""), 500)
    assert [i for p in parts for i in library.encode(p, add_special_tokens=False).ids] == whole


def test_digests_of_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "Same", 5), (3, "Same", 5), (3, "Same", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = bpe.token_digests(docs, WORD).collect()
    none = sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)]
    assert {r.ids_sha256 for r in got if r.n_tokens == 0} == {none} == {r.decoded_sha256 for r in got if r.n_tokens == 0}
    assert bpe.token_digests(docs.limit(0), WORD).count() == 0


def test_columns_round_trip(spark):
    docs = spark.createDataFrame([("a b, C d!",), (None,)], "t string")
    out = docs.select(bpe.encode_column(WORD, F.col("t")).alias("ids"))
    shown = [r[0] for r in out.select(bpe.decode_column(WORD, F.col("ids"))).collect()]
    assert shown == ["a</w> b</w> ,</w> c</w> d</w> !</w>", ""]


def check_pieces(rows, texts, length=1024):
    library = Tokenizer.from_file(BYTE)
    ids = {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for k, t in texts.items()}
    covered = {k: [] for k in ids}
    sequences = {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id].append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, spans in covered.items():
        at = 0
        for s, n in sorted(spans):
            assert s == at and n > 0
            at += n
        assert at == len(ids[k])
    short = 0
    for spans in sequences.values():
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
        assert at <= length
        short += at < length
    assert short <= 1


def test_packing_covers_every_id_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_pieces(packing.pack_documents(docs, BYTE).collect(), texts)


def test_packing_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "many words " * 900, "x"), (4, "same", "x"), (5, "same", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = packing.pack_documents(docs, BYTE, length=64, with_ids=True).collect()
    check_pieces(got, {k: t for k, t, _ in rows}, 64)
    assert all(len(r.ids) == r.length for r in got)
    assert packing.pack_documents(docs.limit(0), BYTE).count() == 0
    again = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert packing.pack_documents(again, BYTE).count() == 2


def test_hilbert_neighbours_differ_in_one_step():
    side = 8
    cells = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    key = packing.hilbert_key(cells, 3)
    assert sorted(key) == list(range(side**3))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
