"""Reading delimited text and vector files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cells import clean_key
from ..operators import histogram as H
from ..plans.matrices import distinct_records, verify_table
from ..session import scratch_dir
from ..sources.delimited import malformed_records
from ..sources.vectors import read_vectors
from ..sources.dialects import read_dialects
from .common import joined, query, table

# Customers as semicolon text with decimal commas. Building customers get an extra field,
# machinery ones lack the last field, and some balances are a missing-value word.
_LINE = """c_name || ' (x);' || c_mktsegment || CASE c_mktsegment WHEN 'MACHINERY' THEN ''
  ELSE ';' || CASE WHEN c_nationkey = 3 THEN 'N/A' ELSE replace(cast(cast(c_acctbal AS DECIMAL(18,2)) AS STRING), '.', ',') END END
  || CASE c_mktsegment WHEN 'BUILDING' THEN ';error' ELSE '' END"""


def _messy_text(spark, d) -> str:
    path = scratch_dir(spark, "text")
    lines = table(spark, d, "customer").select(F.expr(_LINE).alias("line"))
    # The line holds every separator already; the writer's own is a sign that never occurs.
    lines.toDF("MOLECULE_NAME;SMILES;LABEL").write.options(
        header=True, sep="\x01", quote="", escape=""
    ).csv(path)
    return path


@query("""
SELECT replace(c_name, '#', '_') || '_x_' AS name, c_mktsegment AS notation, c_acctbal AS label FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 3
""")
def delimited_ingest(spark, d):
    """Separator, header, quarantine, decimal commas, missing values, keys, first of each name."""
    verified = verify_table(spark, _messy_text(spark, d))
    return distinct_records(verified.rows).select("name", "notation", "label")


@query(f"""
SELECT {_LINE} AS raw, 3 AS expected, CASE c_mktsegment WHEN 'BUILDING' THEN 4 ELSE 2 END AS found,
  c_mktsegment = 'MACHINERY' AS kept FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def malformed_rows(spark, d):
    return malformed_records(spark, _messy_text(spark, d)).select("raw", "expected", "found", "kept")


@query(f"""
SELECT {_LINE} AS raw, 3 AS expected, 4 AS found FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def rejected_rows(spark, d):
    rejects = verify_table(spark, _messy_text(spark, d)).rejects
    return rejects.select("raw", "expected", "found")


@query("""
WITH b AS (SELECT i AS bucket, i::DOUBLE * 55::DOUBLE - 1000 AS e0, (i + 1)::DOUBLE * 55::DOUBLE - 1000 AS e1 FROM range(200) r(i)),
k AS (SELECT DISTINCT c_mktsegment AS name FROM customer)
SELECT name, array_to_string(list(n ORDER BY bucket), ',') AS features FROM (
  SELECT k.name, b.bucket, count(c_acctbal) || '.0' AS n FROM k CROSS JOIN b
  LEFT JOIN customer ON c_mktsegment = k.name AND c_acctbal >= e0 AND (c_acctbal < e1 OR (bucket = 199 AND c_acctbal <= e1))
  GROUP BY k.name, b.bucket) GROUP BY name
""")
def vector_files(spark, d):
    """One vector file per market segment, written by Spark and read back in one scan."""
    path = scratch_dir(spark, "vectors")
    customers = table(spark, d, "customer").withColumn("name", clean_key("c_mktsegment"))
    vectors = H.bucketize(customers, "name", "c_acctbal", -1000.0, 10000.0, 200)
    long = H.vector_long(vectors, "name").select("name", "pos", "value")
    (
        long.repartition("name").sortWithinPartitions("name", "pos").select("name", "value")
        .write.partitionBy("name").csv(path)
    )
    found, _ = read_vectors(spark, path, 200, r"name=([^/]+)/[^/]+\.csv$")
    return found.select("name", joined().alias("features"))


_NAME = """c_name || ';"' || c_mktsegment || '", ' || c_nationkey"""


@query(f"""
SELECT c_custkey AS id, {_NAME} AS name, c_mktsegment AS segment, c_acctbal AS balance, c_custkey % 2 = 0 AS semicolons FROM customer
""")
def mixed_dialects(spark, d):
    """One folder, files of semicolons and of commas with the columns in two orders, read by header name."""
    path = scratch_dir(spark, "dialects")
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.expr(_NAME).alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    write = lambda df, sep: df.write.mode("append").options(header=True, sep=sep, escape='"').csv(path)
    write(rows.filter("id % 2 = 0"), ";")
    write(rows.filter("id % 2 = 1").select("balance", "segment", "id", "name"), ",")
    good, _ = read_dialects(spark, path, names=["id", "name", "segment", "balance"])
    return good.select(
        F.col("id").cast("bigint").alias("id"), "name", "segment", F.col("balance").cast("double").alias("balance"), (F.col("sep") == ";").alias("semicolons"))
