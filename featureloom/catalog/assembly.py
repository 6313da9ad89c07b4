"""Label join, fusion, stacking and the wide form."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import assembly as J
from ..operators import cleaning as P
from ..operators import histogram as H
from ..functions.cells import clean_key
from ..plans.matrices import spectral_matrix
from ..session import scratch_dir, stage
from ..sinks.bucketed import fuse_bucketed, write_bucketed, write_bucketed_labels
from ..sinks.tables import write_matrix
from .buckets import HI, IN_RANGE, LO, N, RANGES
from .common import joined, query, table

AXIS = (LO, HI, N)


def vectors(source: str, where: str = "TRUE", as_text: bool = True) -> str:
    """SQL for one vector per user of the rows that match, zeros included."""
    column = "array_to_string(list(n ORDER BY bucket), ',')" if as_text else "list(n ORDER BY bucket)"
    return f"""
  SELECT user_id AS name, {column} AS features FROM (
    SELECT k.user_id, b.bucket, count(e.value) AS n
    FROM (SELECT DISTINCT user_id FROM {source} WHERE {where}) k CROSS JOIN ({RANGES}) b
    LEFT JOIN (SELECT * FROM {source} WHERE {where}) e ON e.user_id = k.user_id AND {IN_RANGE}
    GROUP BY k.user_id, b.bucket) GROUP BY user_id"""


def user_vectors(spark, d, kind=None):
    events = table(spark, d, "events")
    if kind:
        events = events.filter(F.col("event_type") == kind)
    return H.bucketize(events.withColumnRenamed("user_id", "name"), "name", "value", *AXIS)


def _labelled(spark, d):
    events = table(spark, d, "events").withColumnRenamed("user_id", "name")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("name"), "c_acctbal")
    label = J.label_column(customers, 2)
    return spectral_matrix(events, events, customers, AXIS, label=label)


@query(f"""
SELECT v.name, c_acctbal AS label, features FROM ({vectors('events')}) v
JOIN customer ON c_custkey = v.name WHERE c_acctbal IS NOT NULL
""")
def matrix_labeled(spark, d):
    """The flagship: events per user as a labelled 200-bucket vector."""
    return _labelled(spark, d).select("name", "label", joined().alias("features"))


_WIDE = ", ".join(f"f[{i + 1}] AS FEATURE_{i + 1}" for i in range(N))


@query(f"""
SELECT v.name AS MOLECULE_NAME, c_acctbal AS LABEL, {_WIDE}
FROM (SELECT name, features AS f FROM ({vectors('events', as_text=False)})) v
JOIN customer ON c_custkey = v.name WHERE c_acctbal IS NOT NULL
""")
def matrix_wide(spark, d):
    return J.name_features(_labelled(spark, d), N)


@query(f"""
SELECT v.name::VARCHAR AS MOLECULE_NAME, c_acctbal AS LABEL, features FROM ({vectors('events')}) v
JOIN customer ON c_custkey = v.name WHERE c_acctbal IS NOT NULL
""")
def matrix_roundtrip(spark, d):
    """Written as wide comma text in file order, read back by path and packed again."""
    path = write_matrix(_labelled(spark, d), scratch_dir(spark, "matrix"), N, ordered=True)
    packed = J.split_meta(P.require_columns(J.as_dataframe(spark, path), list(J.META)))
    return packed.select(
        "MOLECULE_NAME", F.col("LABEL").cast("double").alias("LABEL"), joined().alias("features")
    )


@query(f"""
SELECT v.name, o_totalprice AS label, features FROM ({vectors('events')}) v
JOIN orders ON o_custkey = v.name WHERE o_totalprice IS NOT NULL
""")
def label_fanout(spark, d):
    """Repeated label keys give one row per label."""
    labels = table(spark, d, "orders").select(F.col("o_custkey").alias("name"), "o_totalprice")
    rows = J.attach_labels(user_vectors(spark, d), labels, "name", "o_totalprice")
    return rows.select("name", "label", joined().alias("features"))


@query(f"""
WITH f AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS label FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey)
SELECT v.name, label, features FROM ({vectors('events')}) v LEFT JOIN f ON o_custkey = v.name
""")
def labels_first(spark, d):
    """Only the first label of a key; rows without one are kept."""
    labels = table(spark, d, "orders").filter("o_orderstatus <> 'F'").select(
        F.col("o_custkey").alias("name"), "o_orderpriority", "o_orderkey"
    )
    rows = J.attach_labels(
        user_vectors(spark, d), labels, "name", "o_orderpriority",
        labels_mode="first", order=["o_orderkey"], keep_unlabelled=True,
    )
    return rows.select("name", "label", joined().alias("features"))


def _labelled_kind(spark, d, kind):
    """Vectors of one event type; priorities repeat, and some of them are null."""
    labels = table(spark, d, "orders").select(
        F.col("o_custkey").alias("name"),
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
    )
    return J.attach_labels(user_vectors(spark, d, kind), labels, "name", "priority", keep_unlabelled=True)


def _labelled_sql(kind: str) -> str:
    where = f"event_type = '{kind}'"
    return f"""SELECT v.name, nullif(o_orderpriority, '5-LOW') AS label, features
  FROM ({vectors('events', where)}) v LEFT JOIN orders ON o_custkey = v.name"""


@query(f"""
WITH h AS ({_labelled_sql('click')}), c AS ({_labelled_sql('view')})
SELECT h.name, h.label, h.features || ',' || c.features AS features, count(*) AS copies
FROM h JOIN c ON h.name IS NOT DISTINCT FROM c.name AND h.label IS NOT DISTINCT FROM c.label GROUP BY ALL
""")
def hybrid_fusion(spark, d):
    """Two labelled matrices joined on name and label; null labels match."""
    fused = J.fuse(_labelled_kind(spark, d, "click"), _labelled_kind(spark, d, "view"))
    return fused.select("name", "label", joined().alias("features"), "copies")


@query(f"""
WITH h AS ({_labelled_sql('click')}), c AS ({_labelled_sql('view')})
SELECT h.name, h.label, h.features || ',' || c.features AS features
FROM h JOIN c ON h.name IS NOT DISTINCT FROM c.name AND h.label IS NOT DISTINCT FROM c.label
""")
def hybrid_expanded(spark, d):
    """The same fusion with repeated rows written out."""
    fused = J.fuse(_labelled_kind(spark, d, "click"), _labelled_kind(spark, d, "view"))
    return J.expand_copies(fused.select("name", "label", joined().alias("features"), "copies"))


@query(f"""
WITH h AS ({_labelled_sql('click')}), c AS ({_labelled_sql('view')})
SELECT h.name, h.label, h.features || ',' || c.features AS features, count(*) AS copies
FROM h JOIN c ON h.name IS NOT DISTINCT FROM c.name AND h.label IS NOT DISTINCT FROM c.label GROUP BY ALL
""")
def hybrid_bucketed(spark, d):
    """The same fusion from tables bucketed by name: vectors and labels are dealt once, when written, and joined without an exchange."""
    click, view = (write_bucketed(user_vectors(spark, d, kind)) for kind in ("click", "view"))
    orders = table(spark, d, "orders").select("o_custkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    labels = write_bucketed_labels(orders, "o_custkey", "priority")
    fused = fuse_bucketed(click, view, labels=labels, keep_unlabelled=True)
    return fused.select("name", "label", joined().alias("features"), "copies")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity || ',' || l_extendedprice || ',' || l_discount || ',' || l_tax AS features FROM lineitem
""")
def split_meta(spark, d):
    wide = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    packed = J.split_meta(wide, ["l_orderkey", "l_linenumber"])
    return packed.select("l_orderkey", "l_linenumber", joined().alias("features"))


def _stacked(spark, d):
    """Vectors of two widths in one table; only one side has the column ``kind``."""
    events = table(spark, d, "events")
    wide = H.bucketize(events, "user_id", "value", LO, HI, 50).withColumn("kind", F.lit("wide"))
    short = H.bucketize(events, "event_type", "value", LO, HI, 30)
    return J.stack_vectors(
        wide.withColumn("name", F.col("user_id").cast("string")).drop("user_id"),
        short.withColumnRenamed("event_type", "name"),
    )


@query("""
SELECT DISTINCT user_id::VARCHAR AS name, 'wide' AS kind, 50 AS length, 0 AS missing FROM events UNION ALL
SELECT DISTINCT event_type, NULL, 50, 20 FROM events
""")
def stack_and_pad(spark, d):
    padded = J.pad_vectors(_stacked(spark, d), 50)
    missing = F.size(F.filter("features", lambda x: x.isNull()))
    return padded.select("name", "kind", F.size("features").alias("length"), missing.alias("missing"))


@query("""
SELECT DISTINCT user_id::VARCHAR AS name, TRUE AS whole FROM events UNION ALL SELECT DISTINCT event_type, FALSE FROM events
""")
def ragged_vectors(spark, d):
    whole, ragged = J.ragged_vectors(_stacked(spark, d), 50)
    return whole.select("name", F.lit(True).alias("whole")).unionByName(
        ragged.select("name", F.lit(False).alias("whole"))
    )


@query("""
WITH n AS (SELECT page_id, translate(replace(url, ' ', ''), '*&^%$@!~#()[]{}?/\\', '__________________') AS name FROM pages)
SELECT page_id, name, dense_rank() OVER (ORDER BY name || '.csv') AS rank FROM n
""")
def file_order(spark, d):
    """Rows in file name order, with the rank that their place in the output gives."""
    names = table(spark, d, "pages").select("page_id", clean_key("url").alias("name"))
    placed = J.order_like_files(names, "name").withColumn("at", F.monotonically_increasing_id())
    placed = stage(placed, "ordered")
    # The place of a name is that of its first row; only names are ranked, in no single task.
    first = placed.groupBy("name").agg(F.min("at").alias("at"))
    part = F.shiftright("at", 33)
    inside = Window.partitionBy(part).orderBy("at")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = first.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranks = first.select("name", part.alias("part"), F.row_number().over(inside).alias("k")).join(sizes, "part")
    return placed.join(ranks, "name").select("page_id", "name", (F.col("before") + F.col("k")).alias("rank"))
