"""Registered queries of the corpus operators, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureloom.llm import ann, bpe, htmltext, langid, packing, prefixtrie, quality, secrets, simhash, suffixes, syncmers, vafile, warc
from featureloom.llm.shared import crc_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def warc_records(pages):
    """Web archive records of the pages: each as a full response, and a later 304 for the same page.

    The revisit asks for another spelling of the URL. Its ETag agrees, weakly, except where the page number
    divides by 5 (the page had changed) or 7 (no ETag; Last-Modified decides).
    """
    page, etag = F.col("page_id"), F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    at = lambda seconds: F.timestamp_seconds(F.lit(1_700_000_000) + seconds)
    modified = F.concat(F.lit("day "), (page % 365).cast("string"))
    header = lambda *pairs: F.map_filter(F.create_map(*[x for n, v in pairs for x in (F.lit(n), v)]), lambda k, v: v.isNotNull())
    full = pages.select(
        (page * 2).alias("record_id"), "url", at(page * 7).alias("date"), F.lit(200).alias("status"),
        header(("Content-Type", F.lit("text/html")), ("Content-Length", F.octet_length("html").cast("string")), ("ETag", etag),
               ("Last-Modified", modified), ("Cache-Control", F.lit("max-age=60"))).alias("headers"),
        F.sha2("html", 256).alias("digest"),
    )
    again = pages.select(
        (page * 2 + 1).alias("record_id"), F.concat(F.regexp_replace("url", "^https?", "HTTP"), F.lit("#again")).alias("url"),
        at(page * 7 + 40_000 * (page % 3 + 1)).alias("date"), F.lit(304).alias("status"),
        header(("etag", F.when(page % 5 == 0, '"new"').when(page % 7 != 0, F.concat(F.lit("W/"), etag))), ("last-modified", F.when(page % 11 != 0, modified)),
               ("CACHE-CONTROL", F.when(page % 2 == 0, "no-cache")), ("Connection", F.lit("close")), ("content-length", F.lit("0"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return full.union(again)


@query(r"""
WITH c AS (SELECT page_id AS p, html, regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://(.*)$', 1) AS rest FROM pages),
q AS (SELECT p, html,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)?$', ''), '^www[0-9]*\.', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
    list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|fbclid|gclid|msclkid|ref)(=|$)'))) AS params FROM c),
u AS (SELECT p, html, base || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS u FROM q),
full_ AS (SELECT u, 1700000000 + p * 7 AS t, p * 2 AS id, '"' || md5(html) || '"' AS etag, 'day ' || (p % 365) AS modified,
    strlen(html) AS size, sha256(html) AS digest FROM u),
again AS (SELECT u, 1700000000 + p * 7 + 40000 * (p % 3 + 1) AS t, p * 2 + 1 AS id, p,
    CASE WHEN p % 5 = 0 THEN '"new"' WHEN p % 7 <> 0 THEN 'W/"' || md5(html) || '"' END AS etag,
    CASE WHEN p % 11 <> 0 THEN 'day ' || (p % 365) END AS modified, CASE WHEN p % 2 = 0 THEN 'no-cache' END AS cache FROM u),
m AS (SELECT a.*, f.id AS fid, f.t AS ft, f.etag AS fetag, f.modified AS fmodified, f.size, f.digest,
    row_number() OVER (PARTITION BY a.id ORDER BY f.t DESC NULLS LAST, f.id DESC) AS k
  FROM again a LEFT JOIN full_ f ON a.u = f.u AND (f.t < a.t OR (f.t = a.t AND f.id < a.id))),
o AS (SELECT *, CASE WHEN fid IS NULL THEN 'no_response' WHEN coalesce(regexp_replace(etag, '^W/', '') = fetag, modified = fmodified) THEN 'resolved'
    WHEN coalesce(regexp_replace(etag, '^W/', '') = fetag, modified = fmodified) IS NULL THEN 'unvalidated' ELSE 'changed' END AS outcome FROM m WHERE k = 1)
SELECT id AS record_id, u AS canonical_url, CAST(t AS BIGINT) AS date, outcome, fid AS refers_to, CAST(ft AS BIGINT) AS refers_to_date,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN 200 END AS status,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN 'cache-control: ' || coalesce(cache, 'max-age=60') || chr(10) || 'content-length: ' || size || chr(10)
    || 'content-type: text/html' || chr(10) || 'etag: ' || coalesce(etag, fetag) || chr(10) || 'last-modified: ' || coalesce(modified, fmodified) END AS headers,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN digest END AS digest FROM o
""")
def op1_warc(spark, sf_dir):
    found = warc.resolve_revisits(warc_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "\n")
    return found.withColumns({"headers": lines, "date": F.unix_seconds("date"), "refers_to_date": F.unix_seconds("refers_to_date")})


@query("""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, k, substr(x, 1024 * k + 1, 1122) AS y FROM (SELECT doc_id, x, unnest(range(CAST((length(x) - 100) // 1024 + 1 AS BIGINT))) AS k FROM t WHERE length(x) >= 100)),
w AS (SELECT doc_id, k, y, unnest(range(CAST(least(512, length(y) // 2 - 49) AS BIGINT))) AS j FROM b),
s AS (SELECT doc_id, 512 * k + j AS p, md5_number(substr(y, 2 * j + 1, 100)) AS s FROM w),
r AS (SELECT s.doc_id, p FROM s JOIN (SELECT s, min(doc_id) AS low FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)) m USING (s) WHERE s.doc_id > low),
g AS (SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, -1) AS new FROM r),
n AS (SELECT doc_id, p, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g),
z AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM n GROUP BY 1, 2),
e AS (SELECT doc_id, k, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS before FROM z),
f AS (SELECT t.doc_id, any_value(x) AS x, sum(b - a) AS gone, count(k) AS spans, max(b) AS last,
        string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY k) AS kept
      FROM t LEFT JOIN e USING (doc_id) GROUP BY t.doc_id)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(spans AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM f
""")
def op2_suffixes(spark, sf_dir):
    return suffixes.repeat_digests(table(spark, sf_dir, "documents"))


@query()
def op3_simhash(spark, sf_dir):
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op4_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold("doc_id", 5)
    model = langid.fit_languages(docs.where(fold != 0))
    out = langid.predict_languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "lang_pred", "score", "lang_cosine", "lang_rejected")


@query()
def op5_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 20 == 0)


@query()
def op6_syncmers(spark, sf_dir):
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op7_bpe(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def quality_labels(spark, sf_dir):
    """Labelled rows of the documents that may be learned from."""
    labels = quality.one_label(table(spark, sf_dir, "labels"))
    docs = table(spark, sf_dir, "documents").where(crc_fold("doc_id", 3) != 1)
    return docs.select("doc_id", "text").join(labels, "doc_id")


@query()
def op8_quality(spark, sf_dir):
    model = quality.fit_quality(quality_labels(spark, sf_dir))
    out = quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "score", "predicted")


@query()
def op9_htmltext(spark, sf_dir):
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


@query()
def op10_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# crc32 of the digits, bit by bit: a byte enters every eight steps.
_CRC = """xor(list_reduce(range(8 * length(CAST(c AS VARCHAR))), lambda x, j: CASE WHEN (CASE WHEN j % 8 = 0 THEN xor(x, ascii(CAST(c AS VARCHAR)[j // 8 + 1])) ELSE x END) & 1 = 1
  THEN xor((CASE WHEN j % 8 = 0 THEN xor(x, ascii(CAST(c AS VARCHAR)[j // 8 + 1])) ELSE x END) >> 1, 3988292384)
  ELSE (CASE WHEN j % 8 = 0 THEN xor(x, ascii(CAST(c AS VARCHAR)[j // 8 + 1])) ELSE x END) >> 1 END, 4294967295), 4294967295)"""


@query(f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 5 AS b, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
p AS (SELECT k.c, 0 AS side, t.i, role, text FROM k JOIN t ON t.c = k.b AND t.i < k.h UNION ALL SELECT k.c, 1, t.i, role, text FROM k JOIN t ON t.c = k.c AND t.i >= k.h),
o AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, i) AS d, role, text FROM p),
x AS (SELECT c, d, strlen(text) AS bytes, md5(string_agg(md5(role) || md5(text), '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS key FROM o
  UNION ALL SELECT c, 0, 0, '' FROM k),
n AS (SELECT d, key, min(c) AS m, count(*) AS n, any_value(bytes) AS bytes FROM x GROUP BY d, key),
s AS (SELECT x.c, x.d, n.m, x.d = max(x.d) OVER (PARTITION BY x.c) AS final FROM x JOIN n USING (d, key)),
q AS (SELECT n.*, s.m AS pm FROM n LEFT JOIN s ON s.c = n.m AND s.d = n.d - 1),
kids AS (SELECT pm AS m, d - 1 AS d, count(*) AS n_children FROM q WHERE d > 0 GROUP BY 1, 2),
w AS (SELECT q.m, q.d, q.pm, q.n, coalesce(n_children, 0) AS n_children, (q.n - 1) * q.bytes AS saved FROM q LEFT JOIN kids USING (m, d)),
up AS (SELECT s.m, s.d, CAST(sum(CAST(w.n_children = 0 AS INT)) AS BIGINT) AS n_leaves, CAST(sum(w.saved) AS BIGINT) AS saved_tokens FROM w JOIN s ON s.c = w.m AND s.d <= w.d GROUP BY 1, 2),
e AS (SELECT m, d, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM s WHERE final GROUP BY 1, 2)
SELECT m AS conv_id, CAST(d AS BIGINT) AS depth, pm AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM w JOIN up USING (m, d) LEFT JOIN e USING (m, d)
""")
def op11_prefixtrie(spark, sf_dir):
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


_ASCII_ASSIGN = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)") + secrets.ASSIGN.partition("key)")[2]


def _secrets_sql() -> str:
    """The same base spans and the same model: matches zipped with the gaps before them, pairs of characters counted and joined."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    patterns = {"assign": (0, _ASCII_ASSIGN, 2), "access": (1, secrets.ACCESS, 0), "hex": (2, secrets.HEX, 0), "model": (3, secrets.CANDIDATE, 0)}
    values = ", ".join(f"({rank}, '{kind}')" for kind, (rank, _, _) in patterns.items())
    found = " UNION ALL ".join(
        f"""SELECT r, {rank} AS rank, unnest(range(len(string_split_regex(t, {text(p)})))) AS k, unnest(string_split_regex(t, {text(p)})) AS gap,
          unnest(regexp_extract_all(t, {text(p)}, 0)) AS hit, unnest(regexp_extract_all(t, {text(p)}, {g})) AS value FROM t""" for rank, p, g in patterns.values())
    rest = "t"
    for _, p, _ in list(patterns.values())[:3]:
        rest = f"regexp_replace({rest}, {text(p)}, ' ', 'g')"
    digest = lambda salt: f"to_base64(unhex(sha256('{salt}' || id)))"
    pairs = lambda name, sign: f"""SELECT CASE WHEN i > 1 THEN s[i - 1] ELSE '' END AS a, s[i] AS b, count(*) AS {sign}
      FROM (SELECT s, unnest(range(1, length(s) + 1)) AS i FROM {name}) GROUP BY 1, 2"""  # noqa: E731
    size = len(secrets.ALPHABET)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id, coalesce(text, '') AS t FROM documents),
z AS ({found}),
p AS (SELECT r, rank, k, hit, value, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY r, rank ORDER BY k) AS e FROM z),
m AS (SELECT r, rank, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, value FROM p WHERE hit IS NOT NULL AND (rank <> 0 OR length(value) >= {secrets.ASSIGNED})),
base AS (SELECT * FROM m WHERE rank < 3),
few AS (SELECT r, id, t FROM t WHERE (SELECT count(*) FROM t) <= {secrets.SAMPLE} OR md5(id)[1:8] < printf('%08x', ({secrets.SAMPLE} << 32) // (SELECT greatest(count(*), 1) FROM t))),
random AS (SELECT value AS s FROM base JOIN few USING (r) UNION ALL SELECT {digest('a')} FROM few UNION ALL SELECT md5(id) FROM few
  UNION ALL SELECT upper(regexp_replace({digest('b')}, '[^A-Za-z0-9]', '', 'g')) FROM few),
words AS (SELECT unnest(regexp_extract_all({rest}, {text(secrets.WORD)}, 0)) AS s FROM few),
signs AS (SELECT unnest(string_split('{secrets.ALPHABET}', '')) AS b),
grid AS (SELECT a, b FROM (SELECT b AS a FROM signs UNION ALL SELECT '') CROSS JOIN signs),
n AS (SELECT a, b, coalesce(r, 0) AS r, coalesce(o, 0) AS o FROM grid LEFT JOIN ({pairs('random', 'r')}) USING (a, b) LEFT JOIN ({pairs('words', 'o')}) USING (a, b)),
w AS (SELECT a, b, CAST(floor((ln((r + 1.0::DOUBLE) / (sum(r) OVER (PARTITION BY a) + {size}.0::DOUBLE)) - ln((o + 1.0::DOUBLE) / (sum(o) OVER (PARTITION BY a) + {size}.0::DOUBLE))) * 1000 + 0.5) AS BIGINT) AS w FROM n),
c AS (SELECT r, s, e, value, unnest(range(1, length(value) + 1)) AS i FROM m WHERE rank = 3),
d AS (SELECT r, s, e FROM c JOIN w ON w.a = CASE WHEN i > 1 THEN value[i - 1] ELSE '' END AND w.b = value[i]
  GROUP BY r, s, e, value HAVING sum(w) > greatest({secrets.TOTAL}, length(value) * {secrets.AVERAGE}) AND len(list_distinct(string_split(value, ''))) >= {secrets.DIFFERENT}),
x AS (SELECT r, rank, s, e FROM base UNION ALL SELECT r, 3, s, e FROM d WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = d.r AND b.s < d.e AND d.s < b.e)),
y AS (SELECT r, rank, s, kind || ':' || s || ':' || e AS span FROM x JOIN (VALUES {values}) v(rank, kind) USING (rank))
SELECT t.doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY s, rank), '') AS spans
FROM t LEFT JOIN y USING (r) GROUP BY t.r, t.doc_id
"""


@query(_secrets_sql())
def op12_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secrets.span_digests(secrets.find_secrets(docs, secrets.fit_markov(docs)))


def _clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Rounds written out: sums of integers by cluster and dimension, rounded down."""
    near = lambda c: f"""SELECT v.r, v.vec_id, CAST(arg_min(c, [d, c]) AS INT) AS c, min(d) AS d FROM v JOIN (
      SELECT v.r, c.c, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v CROSS JOIN {c} c) USING (r) GROUP BY 1, 2"""  # noqa: E731
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({near(f'c{i}')})")
        steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (
          SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
            SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(range({dims})) AS i, unnest(v.x) AS x FROM a{i} a JOIN v USING (r)) GROUP BY c, i) GROUP BY c) n USING (c))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < {k}),
{", ".join(steps)},
z AS ({near(f'c{rounds}')})
SELECT z.vec_id, z.c AS cluster, z.d AS distance, CAST(sum(z.d) OVER (PARTITION BY z.c) AS BIGINT) AS cluster_inertia, CAST(sum(z.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM z JOIN c{rounds} c USING (c)
"""


@query(_clusters_sql())
def op13_vafile(spark, sf_dir):
    return vafile.cluster_vectors(table(spark, sf_dir, "embeddings"))
