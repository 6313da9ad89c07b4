"""The registered queries: SQL where there is some, the pipeline against its stages in plain Python."""

import pytest
from compare import compare, oracle_connection
from test_duplicates import components, masks, plain_fingerprint
from test_tokens import check_pieces

import __spark_entry__ as entry
import corpus_pipeline
from featureloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    equal, message, rows = compare(spark, oracle_connection(SF), SF, QUERIES[name], ORACLES[name])
    assert equal, message
    assert rows > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    everything = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held, results = docs, []
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, SF)
        rows = held.collect()
        if name != "packing":
            assert held.columns == columns
            held = spark.createDataFrame(rows, held.schema)
        results.append(rows)
    good, told, single, cut, packed = results
    kept = {r.doc_id for r in good}
    known = [i for i in everything if i in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.95 * len(known)
    assert len(told) >= 0.97 * len(good) and {r.doc_id for r in told} <= kept
    rows = sorted((r.doc_id, r.text) for r in told)
    root = components([plain_fingerprint(t) for _, t in rows])
    assert sorted(r.doc_id for r in single) == sorted(rows[k][0] for k in set(root))
    assert all(r == everything[r.doc_id] for r in single)
    want = {}
    for i, b, gone in masks(sorted((r.doc_id, r.text) for r in single)):
        kept_text, p = "", 0
        for c in b.decode():
            n = len(c.encode())
            kept_text += "" if gone[p : p + n].all() else c
            p += n
        want[i] = kept_text
    assert {r.doc_id: r.text for r in cut} == want
    assert all(r.n_chars == len(r.text) for r in cut)
    check_pieces(packed, want)
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, packed))


def test_null_texts_pass_through_the_stages(spark):
    odd = spark.createDataFrame([(10_001, None, "en", "s", 0), (10_002, "", None, "s", None), (None, "Words of a text without an id.", "en", None, 30)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(odd.columns).union(odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() > 0, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
