"""Cell cleaning, null handling, dedup, routing and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells as C
from ..operators import cleaning as P
from ..operators import quality as Q
from ..operators.assembly import as_dataframe
from ..session import scratch_dir
from ..sinks.tables import append_log, write_verified
from .common import query, table


@query("""
SELECT page_id, translate(regexp_replace(url, '^\\s+|\\s+$|[ \\t]', '', 'g'),
       '*&^%$@!~#()[]{}?/\\', '__________________') AS url FROM pages
""")
def clean_keys(spark, d):
    return P.clean_keys(table(spark, d, "pages").select("page_id", "url"), "url")


_PRICE = """CASE WHEN p_size % 7 = 0 THEN '1,2,' || p_size WHEN p_size % 7 = 1 THEN '1.2,' || p_size
  WHEN p_size % 7 = 2 THEN '-0,' || p_size WHEN p_size % 7 = 3 THEN ',' || p_size
  WHEN p_size % 7 = 4 THEN p_size || ',' WHEN p_size % 7 = 5 THEN 'x,' || p_size
  ELSE replace(cast(cast(p_retailprice AS DECIMAL(18,2)) AS STRING), '.', ',') END"""


def _prices(spark, d):
    return table(spark, d, "part").select("p_partkey", F.expr(_PRICE).alias("price"))


@query(f"""
WITH s AS (SELECT p_partkey, {_PRICE} AS price FROM part),
f AS (SELECT p_partkey, length(price) - length(replace(price, ',', '')) = 1
        AND try_cast(replace(price, ',', '.') AS DOUBLE) IS NOT NULL AND NOT contains(price, '.') AS was_comma, price
      FROM s)
SELECT p_partkey, CASE WHEN was_comma THEN replace(price, ',', '.') ELSE price END AS price, was_comma,
       CASE WHEN was_comma THEN try_cast(replace(price, ',', '.') AS DOUBLE) END AS value FROM f
""")
def decimal_comma(spark, d):
    raw = _prices(spark, d).withColumn("was_comma", C.is_decimal_comma("price"))
    fixed = P.fix_decimal_commas(raw, ["price"])
    return fixed.withColumn("value", C.to_double("price"))


@query(f"""
WITH s AS (SELECT {_PRICE} AS price FROM part)
SELECT 'price' AS column, count(*) FILTER (WHERE length(price) - length(replace(price, ',', '')) = 1
   AND NOT contains(price, '.') AND try_cast(replace(price, ',', '.') AS DOUBLE) IS NOT NULL) AS n FROM s
""")
def decimal_comma_report(spark, d):
    return P.decimal_comma_report(_prices(spark, d))


_TOKEN = """CASE o_orderpriority WHEN '1-URGENT' THEN 'N/A' WHEN '2-HIGH' THEN 'None'
  WHEN '5-LOW' THEN '' ELSE o_orderpriority END"""


@query(f"""
SELECT o_orderkey, nullif(nullif(nullif({_TOKEN}, 'N/A'), 'None'), '') AS priority,
       nullif(CASE WHEN o_orderstatus = 'F' THEN 'nan' ELSE o_orderstatus END, 'nan') AS status FROM orders
""")
def null_tokens(spark, d):
    raw = table(spark, d, "orders").select(
        "o_orderkey", F.expr(_TOKEN).alias("priority"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'nan' ELSE o_orderstatus END").alias("status"),
    )
    return P.null_tokens(raw)


def _labelled_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, d, "labels"), "doc_id", "left")


@query("""
SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE lang IS NOT NULL AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL
""")
def drop_incomplete(spark, d):
    return P.drop_incomplete(_labelled_documents(spark, d))[0]


@query("""
WITH j AS (SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS column, count(*) - count(doc_id) AS n FROM j UNION ALL
SELECT 'lang', count(*) - count(lang) FROM j UNION ALL SELECT 'n_chars', count(*) - count(n_chars) FROM j UNION ALL
SELECT 'quality', count(*) - count(quality) FROM j UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j
""")
def null_report(spark, d):
    return P.drop_incomplete(_labelled_documents(spark, d))[1]


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def take_columns(spark, d):
    return P.take_columns(table(spark, d, "lineitem"), 3)


_CELL = """CASE l_linenumber WHEN 1 THEN l_quantity || 'd' WHEN 2 THEN l_quantity || 'e1' WHEN 3 THEN 'nan'
  WHEN 4 THEN ' ' || l_tax WHEN 5 THEN '1_0' WHEN 6 THEN '' ELSE '-' || l_discount END"""


@query("""
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 2 THEN l_quantity * 10 WHEN 4 THEN l_tax
  WHEN 1 THEN NULL WHEN 3 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE -l_discount END AS value FROM lineitem
""")
def typed_cast(spark, d):
    cells = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(_CELL).alias("cell")
    )
    return cells.select("l_orderkey", "l_linenumber", C.to_double("cell").alias("value"))


@query("""
SELECT p_partkey, replace(replace(replace('C/' || p_name || '=C\\[C@@H]@' || p_type, '@', ''), '/', ''), '\\', '') AS notation
FROM part
""")
def strip_stereo(spark, d):
    marked = F.concat(F.lit("C/"), "p_name", F.lit("=C\\[C@@H]@"), "p_type")
    return table(spark, d, "part").select("p_partkey", C.strip_stereo(marked).alias("notation"))


@query("SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM documents")
def strip_ansi(spark, d):
    """Escape sequences put around and inside the texts leave no trace."""
    esc = "\x1b"
    coloured = F.concat(
        F.lit(f"{esc}[38;5;46m"), F.replace("text", F.lit(" "), F.lit(f"{esc}[0m {esc}M")),
        F.lit(f"{esc}[2K"),
    )
    clean = C.strip_ansi(coloured)
    docs = table(spark, d, "documents").select("doc_id", clean.alias("text"))
    return docs.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("chars"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / 3, 2) AS value FROM lineitem")
def format_shift(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", C.format_shift(F.col("l_extendedprice") / 3).alias("value")
    )


@query("""
SELECT doc_id, text, lang, source, n_chars FROM
  (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1
""")
def dedup_first(spark, d):
    return Q.dedup_keep_first(table(spark, d, "documents"), ["text"], ["doc_id"])


@query("""
SELECT count(*) AS rows, count(DISTINCT text) AS keys, count(*) - count(DISTINCT text) AS duplicates FROM documents
""")
def duplicate_report(spark, d):
    return Q.duplicate_report(table(spark, d, "documents"), ["text"])


def _part_reasons(spark, d):
    return Q.flag_rules(table(spark, d, "part"), {
        "large": F.col("p_size") > 40,
        "promotion": F.col("p_type") == "PROMO",
        "red": F.col("p_name").startswith("red"),
        "dear": F.col("p_retailprice") > 1000,
    })


_REASONS = """list_filter([CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_type = 'PROMO' THEN 'promotion' END,
  CASE WHEN starts_with(p_name, 'red') THEN 'red' END, CASE WHEN p_retailprice > 1000 THEN 'dear' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT p_partkey, array_to_string({_REASONS}, ', ') AS reasons FROM part")
def rule_flags(spark, d):
    return _part_reasons(spark, d).select("p_partkey", F.array_join("reasons", ", ").alias("reasons"))


@query(f"""
WITH r AS (SELECT p_type, len({_REASONS}) > 0 AS rerouted FROM part)
SELECT p_type, count(*) FILTER (WHERE NOT rerouted) AS direct, count(*) FILTER (WHERE rerouted) AS rerouted FROM r GROUP BY p_type
""")
def route_counts(spark, d):
    direct, other = Q.route(_part_reasons(spark, d))
    both = direct.select("p_type", F.lit(True).alias("ok")).unionByName(
        other.select("p_type", F.lit(False).alias("ok"))
    )
    return both.groupBy("p_type").agg(
        F.count_if("ok").alias("direct"), F.count_if(~F.col("ok")).alias("rerouted")
    )


@query(f"""
SELECT p_partkey, p_partkey || ': rerouted → ' || array_to_string({_REASONS}, ', ') AS warning
FROM part WHERE len({_REASONS}) > 0
""")
def route_warnings(spark, d):
    return Q.warnings(_part_reasons(spark, d), "p_partkey")


@query(f"""
SELECT p_partkey, array_to_string({_REASONS}, ', ') AS reasons FROM part WHERE len({_REASONS}) > 0 UNION ALL
SELECT p_partkey, array_to_string({_REASONS}, ', ') FROM part WHERE len({_REASONS}) = 0
""")
def warning_log(spark, d):
    """Both routes appended to one log table, one after the other."""
    path = scratch_dir(spark, "log")
    direct, other = Q.route(_part_reasons(spark, d))
    for branch in (other, direct):
        append_log(branch.select("p_partkey", "reasons"), path)
    return spark.read.parquet(path)


@query("""
SELECT c_custkey::VARCHAR AS c_custkey, replace(c_name, '#', '_') AS c_name, c_acctbal::VARCHAR AS c_acctbal FROM customer
""")
def verified_sink(spark, d):
    """A cleaned table written as comma text and read back by its path."""
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = write_verified(P.clean_keys(customers, "c_name"), scratch_dir(spark, "verified"))
    return as_dataframe(spark, path)


def _points(spark, d):
    """Embedding components taken two by two as points of the plane."""
    pair = lambda i: F.array(
        F.get("embedding", i * 2).cast("double"), F.get("embedding", i * 2 + 1).cast("double")
    )
    index = F.sequence(F.lit(0), F.floor(F.size("embedding") / 2).cast("int") - 1)
    return table(spark, d, "embeddings").select(
        "vec_id", "label", F.transform(index, pair).alias("points")
    )


_NORMS = """list_max(list_transform(range(len(embedding) // 2), lambda i:
  sqrt(embedding[2*i+1]::DOUBLE * embedding[2*i+1]::DOUBLE + embedding[2*i+2]::DOUBLE * embedding[2*i+2]::DOUBLE)))"""


@query(f"SELECT vec_id, label FROM embeddings WHERE {_NORMS} < 0.3")
def degenerate_points(spark, d):
    return Q.reject_degenerate(_points(spark, d), "points", 0.3)[1].select("vec_id", "label")


@query(f"SELECT vec_id, {_NORMS} AS max_norm FROM embeddings WHERE {_NORMS} < 0.3")
def degenerate_keys(spark, d):
    """The same rule over one row per point."""
    rows = _points(spark, d).select("vec_id", F.explode("points").alias("p"))
    flat = rows.select("vec_id", F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y"))
    return Q.degenerate_keys(flat, "vec_id", ["x", "y"], 0.3)


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def failed_keys(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return Q.failed_keys(docs, table(spark, d, "labels"), "doc_id")


@query("""
SELECT 'documents' AS stage, 'rows' AS metric, count(*) AS value FROM documents UNION ALL
SELECT 'documents', 'languages', count(DISTINCT lang) FROM documents UNION ALL
SELECT 'documents', 'empty', count(*) FILTER (WHERE n_chars = 0) FROM documents UNION ALL
SELECT 'labels', 'rows', count(*) FROM labels UNION ALL
SELECT 'labels', 'toxic', count(*) FILTER (WHERE toxic = 1) FROM labels UNION ALL
SELECT 'unlabelled', 'rows', count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def data_quality(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    rows = F.count(F.lit(1))
    return Q.run_summary({
        "documents": (docs, {
            "rows": rows, "languages": F.count_distinct("lang"),
            "empty": F.count_if(F.col("n_chars") == 0),
        }),
        "labels": (labels, {"rows": rows, "toxic": F.count_if(F.col("toxic") == 1)}),
        "unlabelled": (Q.failed_keys(docs, labels, "doc_id"), {"rows": rows}),
    })
