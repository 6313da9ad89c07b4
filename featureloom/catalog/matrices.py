"""The named modes from graphs to labelled matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import backoff as B
from ..operators import graph as G
from ..operators.assembly import expand_copies
from ..operators.rowgraphs import notation_paths
from ..plans import matrices as M
from ..session import spread, stage
from .common import joined, query, table
from .graphs import bits_sql, conversation_graph, signature_sql

# Turns of one role play the part of one nucleus: the text length is looked up by the
# surroundings of the turn, and the answers of a conversation become a 200-bucket vector.
_AXES = {"user": (0.0, 4000.0, 200), "assistant": (0.0, 8000.0, 200)}
_SUPPORT = 5


def _lookup(spark, d):
    """Signatures of all turns and the table fitted on them, both written once."""
    nodes, edges = conversation_graph(spark, d)
    known = table(spark, d, "conversations").select(
        F.col("conv_id").alias("graph_id"), F.col("turn").alias("node_id"),
        F.length("text").cast("decimal(18,2)").alias("known"),
    )
    signatures = stage(G.circular_signatures(nodes, edges, 2), "signatures")
    train = signatures.join(known, ["graph_id", "node_id"])
    return signatures, stage(B.fit_backoff(train, M.signature_levels(2), "known"), "fit")


def _values(lookup, role):
    return M.predict_values(*lookup, 2, target=role, min_support=_SUPPORT)


def _names(spark, d):
    return table(spark, d, "conversations").select(F.col("conv_id").alias("name")).distinct()


def _labels(spark, d):
    """Quality of the document with the same number; conversations beyond them have none."""
    return table(spark, d, "labels").select(F.col("doc_id").alias("name"), "quality")


def _vectors_sql(role: str) -> str:
    hi = int(_AXES[role][1])
    step = hi // 200
    return f"""SELECT name, array_to_string(list(n ORDER BY i), ',') AS features FROM (
    SELECT k.name, r.i, count(v.value) AS n FROM (SELECT DISTINCT conv_id AS name FROM conversations) k CROSS JOIN range(200) r(i)
    LEFT JOIN answers v ON v.name = k.name AND v.role = '{role}' AND v.value >= r.i * {step}
      AND (v.value < (r.i + 1) * {step} OR (r.i = 199 AND v.value <= {hi})) GROUP BY k.name, r.i) GROUP BY name"""


_ANSWERS = f"""{signature_sql(2)},
known AS (SELECT conv_id AS g, turn AS n, role, length(text)::DECIMAL(18,2) AS v FROM conversations),
sig AS (SELECT s0.g, s0.n, s0.h AS h0, s1.h AS h1, s2.h AS h2, role, v FROM s0 JOIN s1 USING (g, n) JOIN s2 USING (g, n) JOIN known USING (g, n)),
f0 AS (SELECT h0, sum(v)::DOUBLE / count(*) AS mean FROM sig GROUP BY h0 HAVING count(*) >= {_SUPPORT}),
f1 AS (SELECT h1, sum(v)::DOUBLE / count(*) AS mean FROM sig GROUP BY h1 HAVING count(*) >= {_SUPPORT}),
f2 AS (SELECT h2, sum(v)::DOUBLE / count(*) AS mean FROM sig GROUP BY h2 HAVING count(*) >= {_SUPPORT}),
answers AS (SELECT g AS name, role, round(coalesce(f2.mean, f1.mean, f0.mean), 2) AS value
  FROM sig LEFT JOIN f0 USING (h0) LEFT JOIN f1 USING (h1) LEFT JOIN f2 USING (h2))"""


@query(f"""
WITH {_ANSWERS}
SELECT v.name, quality AS label, features FROM ({_vectors_sql('user')}) v JOIN labels ON doc_id = v.name WHERE quality IS NOT NULL
""")
def spectral_matrix(spark, d):
    values = _values(_lookup(spark, d), "user")
    matrix = M.spectral_matrix(values, _names(spark, d), _labels(spark, d), _AXES["user"], label="quality")
    return matrix.select("name", "label", joined().alias("features"))


@query(f"""
WITH {_ANSWERS}, pri AS (SELECT o_custkey AS name, o_orderstatus AS label FROM orders)
SELECT a.name, x.label, a.features || ',' || b.features AS features FROM ({_vectors_sql('user')}) a
JOIN ({_vectors_sql('assistant')}) b ON a.name = b.name JOIN pri x ON x.name = a.name JOIN pri y ON y.name = a.name AND y.label = x.label
""")
def hybrid_matrix(spark, d):
    """Both roles fused; repeated labels of a name multiply, as in a join of two matrices."""
    lookup = _lookup(spark, d)
    sides = [
        M.spectral_vectors(_values(lookup, role), _names(spark, d), axis) for role, axis in _AXES.items()
    ]
    labels = table(spark, d, "orders").select(F.col("o_custkey").alias("name"), "o_orderstatus")
    fused = M.hybrid_matrix(*sides, labels, label="o_orderstatus")
    return expand_copies(fused).select("name", "label", joined().alias("features"))


_CHAIN = "translate(p_name, ' abcdefghijklmnopqrstuvwxyz', 'OCNCCCNCCCCCCCCCCCCSCCCCCPC')"


FINGERPRINTS = f"""
WITH c AS (SELECT p_partkey, p_type AS label, {_CHAIN} AS s FROM part),
ok AS (SELECT * FROM c WHERE length(s) > 0),
k AS (SELECT p_partkey, label, s, unnest(range(1, 8)) AS len FROM ok),
w AS (SELECT p_partkey, array_to_string(string_split(substr(s, i, len + 1), ''), '-') AS fwd
      FROM (SELECT *, unnest(range(1, length(s) - len + 1)) AS i FROM k)),
{bits_sql("SELECT DISTINCT p_partkey, least(fwd, reverse(fwd)) AS sig FROM w", "p_partkey", 2)}
SELECT p_partkey AS name, p_type AS label, bits FROM prints JOIN part USING (p_partkey)
"""


@query(FINGERPRINTS)
def fingerprint_matrix(spark, d):
    """Part names spelled as chains of atoms: notation, paths, bits, label."""
    parts = spread(table(spark, d, "part").select("p_partkey", "p_name", "p_type")).select(
        F.col("p_partkey").alias("name"), "p_type", F.expr(_CHAIN).alias("notation")
    )
    words, _ = notation_paths(parts, "name", "notation", dense=False)
    matrix = M.fingerprint_matrix(words, parts.select("name", "p_type"), label="p_type")
    bits = F.array_join(F.col("features").cast("array<string>"), "")
    return matrix.select("name", "label", bits.alias("bits"))
