"""The trained operators: held-out accuracy, odd rows, and the parts that can be stated exactly."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureloom.llm import htmltext, langid, quality
from featureloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "12 34 !!"), (4, "Ein Wort"), (4, "Ein Wort"), (None, "x" * 500_000)]


def test_languages_are_told_on_held_out_documents(spark):
    got = QUERIES["op4_langid"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    assert sum(r.lang_rejected for r in got.collect()) <= 0.01 * got.count()


def test_language_of_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(docs, per_language=60)
    odd = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("Score", F.lit("old"))
    got = langid.predict_languages(odd, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "lang_cosine", "lang_rejected"]
    rows = sorted(got.select("doc_id", "lang_pred", "score", "lang_rejected").collect(), key=repr)
    und = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all(r.lang_pred == "und" and r.score == 0 and r.lang_rejected for r in und)
    same = [r for r in rows if r.doc_id == 4]
    assert same[0] == same[1] and same[0].lang_pred in model.languages
    assert [r.lang_rejected for r in rows if r.doc_id is None] == [True]  # far from everything learned
    assert langid.predict_languages(odd.limit(0), model).count() == 0
    none = langid.fit_languages(docs.limit(0))
    assert none is None and {r.lang_pred for r in langid.predict_languages(odd, none).collect()} == {"und"}


FOREIGN = [
    "Il governo ha annunciato ieri una nuova legge sulla scuola pubblica. Molti insegnanti sono scesi in piazza per protestare contro i tagli. Secondo il ministro, la riforma porterà maggiori risorse alle regioni del sud. Gli studenti però non sono convinti e chiedono un incontro con le autorità.",
    "O governo anunciou ontem uma nova lei sobre a escola pública. Muitos professores saíram às ruas para protestar contra os cortes. Segundo o ministro, a reforma trará mais recursos para as regiões do sul. Os estudantes, porém, não estão convencidos e pedem uma reunião com as autoridades.",
    "De regering heeft gisteren een nieuwe wet over het openbaar onderwijs aangekondigd. Veel leraren gingen de straat op om te protesteren tegen de bezuinigingen. Volgens de minister brengt de hervorming meer geld naar de zuidelijke regio's. De studenten zijn echter niet overtuigd en vragen om een gesprek met de overheid.",
    "Regeringen meddelade i går en ny lag om den offentliga skolan. Många lärare gick ut på gatorna för att protestera mot nedskärningarna. Enligt ministern kommer reformen att ge mer pengar till de södra regionerna. Studenterna är dock inte övertygade och begär ett möte med myndigheterna.",
]


def test_languages_that_were_not_learned_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) > 200").cache()
    for lang in ("de", "en", "es", "fr"):
        model = langid.fit_languages(docs.where(F.col("lang") != lang), per_language=200)
        left = langid.predict_languages(docs.where(F.col("lang") == lang).limit(300), model)
        assert left.where("lang_rejected").count() >= 0.95 * 300
    docs.unpersist()


def test_texts_of_four_sentences_in_other_languages_are_rejected(spark):
    model = langid.fit_languages(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    rows = spark.createDataFrame(list(enumerate(FOREIGN)), "doc_id long, text string")
    assert [r.lang_rejected for r in langid.predict_languages(rows, model).orderBy("doc_id").collect()] == [True] * len(FOREIGN)
    short = [(0, "Das ist nicht gut und es war auch nicht schön"), (1, "This is not what they had been told about it"), (2, "Ce n'est pas ce que nous avons dans la maison")]
    got = langid.predict_languages(spark.createDataFrame(short, "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.lang_rejected) for r in got] == [("de", False), ("en", False), ("fr", False)]


def test_counts_of_a_long_text_are_those_of_its_parts(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 50
    whole = langid.ngram_counts([text])
    import featureloom.llm.text as shared

    monkeypatch.setattr(langid, "cut_text", lambda t: shared.cut_text(t, 300))
    cut = langid.ngram_counts([text])
    assert np.abs(whole - cut).sum() <= 0.01 * whole.sum()


def test_clusters_are_unit_rows():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((50, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(np.linalg.norm(langid.cluster(x, 4), axis=1), 1)
    assert len(langid.cluster(x[:2], 4)) == 2


def test_quality_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op8_quality"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t * 5, y) for i in range(30) for t, y in (("good words here. ", 1), ("BUY!! NOW!! ", 0))], "doc_id long, text string, quality int")
    model = quality.fit_quality(docs)
    odd = spark.createDataFrame([*ODD, (5, "BUY!! IT!! NOW!!"), (6, "words here.")], "doc_id long, text string").withColumn("score", F.lit("old"))
    got = quality.score_quality(odd, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert rows[(5, "BUY!! IT!! NOW!!")].predicted == 0 and rows[(6, "words here.")].predicted == 1
    assert rows[(1, None)].score == rows[(2, "")].score
    assert all(r.predicted == int(r.score >= 0.5) for r in rows.values()) and got.count() == len(ODD) + 2
    empty = quality.fit_quality(docs.limit(0))
    assert {r.score for r in quality.score_quality(odd, empty).collect()} == {0.5}
    assert quality.score_quality(odd.limit(0), model).count() == 0


def test_scores_of_one_text_do_not_depend_on_the_batch():
    model = quality.QualityModel(np.random.default_rng(0).standard_normal(1 << quality.BUCKET_BITS), 0.1)
    texts = ["a b c", "", "Some other words, and more.", "x", "\n \n"]
    together = model.score(texts)
    assert np.allclose(together, [model.score([t])[0] for t in texts])


@pytest.fixture(scope="module")
def forest(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").orderBy("page_id").limit(120).collect()
    return htmltext.fit_forest([r.html for r in rows])


def test_articles_of_the_tables(spark):
    got = {r.page_id: r for r in QUERIES["op9_htmltext"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in pages:
        page = htmltext.parse(r.html)
        inside = htmltext.article_blocks(page)
        want = "\n".join(t for (_, t, _), good in zip(page.blocks, inside) if good)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


PAGE = """<html><head><title>x</title><script>var a="<p>no</p>";</script></head><body><header><h1>Site name</h1>
<nav><a href=/>Home</a></nav></header><div id=cookie-banner>We use cookies to do things on this site. Accept?</div>
<main><article><h2>Big &amp; title</h2><p>First   para with <a href=x>link</a> and <em>some</em>
words that go on.<p>Second para, with many words in it; it is long enough to count.<ul><li>item one of the list<li>item two</ul>
</article><section id="comments"><h3>Comments</h3><p>Nice post, thank you for the words!</p></section></main>
<form><input><button>Go</button>Search</form><footer><p>Copyright 2020</p></footer></body></html>"""
LINES = ["Big & title", "First para with link and some words that go on.", "Second para, with many words in it; it is long enough to count.", "item one of the list", "item two"]


def test_another_layout(forest):
    assert htmltext.main_text(PAGE, forest).split("\n") == LINES


def test_rebuilt_pages(forest):
    rng = np.random.default_rng(77)
    right = total = 0
    for k in range(60):
        content = [f"Paragraph {k} {j} has quite a few words, as such texts do, and ends here." for j in range(2 + k % 5)]
        source, inside = htmltext.rebuilt(content, ["some menu words of the page here"], rng)
        page = htmltext.parse(source)
        keep = htmltext.decode(page.parent, forest.score(htmltext.node_features(page)))
        right += sum(keep[node] == good for (node, _, _), good in zip(page.blocks, inside))
        total += len(inside)
    assert right >= 0.97 * total


def test_decoding_keeps_a_set_closed_towards_the_root():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(2, 9))
        parent = [-1, *[int(rng.integers(0, v)) for v in range(1, n)]]
        logit = rng.standard_normal(n)
        best = -np.inf
        for bits in range(1 << (n - 1)):
            keep = [True, *[bool(bits >> v & 1) for v in range(n - 1)]]
            if all(keep[parent[v]] for v in range(1, n) if keep[v]):
                best = max(best, logit[keep].sum())
        found = htmltext.decode(parent, logit)
        assert all(found[parent[v]] for v in range(1, n) if found[v]) and np.isclose(logit[found].sum(), best)


def test_parsing_never_fails(forest):
    for source in ["", "plain &lt;text&gt;\n only", "<p>a<p>b", "<div><<<>></p></div></div><b>x</i>", "<script>", "<!-- open", "<ul><li>1<ul><li>2</ul><li>3</ul>", "<a", "<div " + "x" * 5000]:
        htmltext.main_text(source, forest)
    assert htmltext.main_text("plain &lt;text&gt;\n only", forest) == "plain <text> only"
    nested = htmltext.parse("<ul><li>1<ul><li>2</ul><li>3</ul>")
    assert [t for _, t, _ in nested.blocks] == ["1", "2", "3"]
    table = htmltext.parse("<table><tr><td>a<td>b<tr><td>c</table>d")
    assert [t for _, t, _ in table.blocks] == ["a", "b", "c", "d"]


def test_pages_without_the_end_of_head_or_in_one_form(forest):
    for page in (PAGE.replace("</head>", ""), PAGE.replace("<body>", "<body><form><input type=hidden name=v>").replace("</body>", "</form></body>")):
        assert page != PAGE or "</head>" not in PAGE
        assert htmltext.main_text(page, forest).split("\n") == LINES
    bare = htmltext.parse("<head><title>x</title><article><p>Words of the page</p></article>")
    assert [t for _, t, _ in bare.blocks] == ["Words of the page"]
    assert [t for _, t, _ in htmltext.parse("<body><form><p>In a form<input></form>").blocks] == ["In a form"]


def test_upper_case_counts_over_the_whole_block():
    low, high = (htmltext.node_features(htmltext.parse("<p>" + "a" * 300 + c * 300)) for c in "bB")
    assert not np.array_equal(low, high)


def test_pages_of_odd_rows(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", PAGE, "t"), (3, "u", PAGE, "t"), (3, "u", PAGE, "t"), (4, "u", "<p>" + "many words " * 60_000 + "</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = {r.page_id: r.text for r in got.collect()}
    assert text[1] == text[2] == "" and text[3] == text[None] and got.count() == 6
    assert len(text[4]) == len("many words " * 60_000) - 1
    assert htmltext.extract_text(pages.limit(0)).count() == 0


def test_quotes_outside_of_values():
    texts = lambda s: [t for _, t, _ in htmltext.parse(s).blocks]
    assert texts('<article><p class=x">Hello there</p></article>') == ["Hello there"]
    assert texts('<p title="it is 5" tall">Hello</p><p>you</p>') == ["Hello", "you"]
    assert texts("<p a=\"x>y\" b = 'it>s'>k</p>") == ["k"]
    assert texts('<p t="never closed>one</p><p>two</p>') == ["one", "two"]
    assert texts('<p t="closed by the next>one</p><p u="x">two</p>') == ["two"]  # as HTML has it: the value ends at the next quote
    assert texts("a <b and 2 < 3") == ["a <b and 2 < 3"]
    assert texts("one<!-- <p>x</p> --><p>two<!-- open <p>three") == ["one", "two"]
    assert htmltext.parse("").blocks == htmltext.parse("<").blocks[:0] == []


@pytest.mark.parametrize("begin,after", [
    ("<a ", ""), ('<a x="', ""), ("<a x='>", ""), ("</script ", ""), ("<script></script ", ""), ("<div>", ""), ("<div>", "</x>"),
    ("<b>", "<div></div>"), ("<div>", "<li></li>"), ("<i><div><b>", "</i>"),
])
def test_parsing_is_linear(begin, after):
    """A page of 1 MB; what is quadratic would take minutes to hours."""
    n = 1_000_000 // len(begin + after)
    start = time.perf_counter()
    htmltext.parse(begin * n + after * n)
    assert time.perf_counter() - start < 20


GOLD = {
    '<html><head><title>t</title><body><div class=nav"><a href=/a>Home</a> <a href=/b>News</a></div><article><h1 class=x">The river</h1>'
    '<p title="it is 5" tall">The river rises in the hills and flows west, past two towns, before it meets the sea near the old harbour.</p>'
    "<p>It is deep, and ships of all kinds have used it for many centuries, as the records tell.</p></article><footer>Copyright 2020</footer>":
    ["The river", "The river rises in the hills and flows west, past two towns, before it meets the sea near the old harbour.",
     "It is deep, and ships of all kinds have used it for many centuries, as the records tell."],
    "<html><body><nav><ul><li><a href=/>Home</a><li><a href=/x>Topics</a></ul></nav><article><p>The area of the disc is <math><mi>A</mi><mo>=</mo>"
    "<mi>p</mi></math> where the radius is known, as the ancient writers found out long ago.</p><p>A second paragraph says where the rule was first "
    "written down, and who read it afterwards.</p></article></body></html>":
    ["The area of the disc is A=p where the radius is known, as the ancient writers found out long ago.",
     "A second paragraph says where the rule was first written down, and who read it afterwards."],
    '<body><div id="menu"><a href=1>One</a><a href=2>Two</a><a href=3>Three</a></div><div id="content"><p>Bees carry pollen from flower to flower, '
    "and many crops depend on them for their harvest each year.</p><p>Where meadows disappear, the number of bees falls, and farmers have to bring "
    'hives from far away.</p></div><div class="sidebar"><a href=5>Related</a></div><form><input name=q><button>Search</button></form></body>':
    ["Bees carry pollen from flower to flower, and many crops depend on them for their harvest each year.",
     "Where meadows disappear, the number of bees falls, and farmers have to bring hives from far away."],
}


@pytest.mark.parametrize("source", GOLD)
def test_pages_written_by_hand(forest, source):
    assert htmltext.main_text(source, forest).split("\n") == GOLD[source]


def test_samples_of_the_fits_stay_off_the_driver(spark, monkeypatch):
    """Both fits run in a task; the driver collects the model and counts."""
    monkeypatch.setattr(type(spark.range(1)), "toArrow", lambda self: pytest.fail("a sample came to the driver"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit_languages(docs, per_language=20)
    assert model.languages == sorted(r.lang for r in docs.where("lang is not null").select("lang").distinct().collect())
    scorer = quality.fit_quality(docs.selectExpr("doc_id", "text", "cast(doc_id % 2 as int) AS quality"), sample=50)
    assert scorer.weight.any()
