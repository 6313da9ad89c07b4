"""Graph construction, signatures, fingerprints and back-off lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import words_to_bitstring
from ..operators import backoff as B
from ..operators import fingerprints as FP
from ..operators import fragments as FR
from ..operators import graph as G
from ..operators import quality as Q
from ..operators import subgraphs as SG
from ..plans.matrices import fingerprint_matrix
from ..session import dealt, spread, stage
from .common import query, table

# One notation per part: a chain, a branch and a ring, sized by the row's own values.
_NOTATION = """repeat('C', CAST(1 + p_size % 10 AS INT)) || '(' || repeat('O', CAST(1 + p_partkey % 3 AS INT)) || ')c1ccccc1'"""
_CHAIN, _BRANCH = "(1 + p_size % 10)", "(1 + p_partkey % 3)"


def _parts(spark, d, expr):
    columns = ["p_partkey", "p_size", "p_type"]
    return spread(table(spark, d, "part").select(*columns)).select(
        "p_partkey", F.expr(expr).alias("notation")
    )


def _part_graphs(spark, d, expr=_NOTATION):
    rows = _parts(spark, d, expr)
    return G.notation_to_graph(rows, "p_partkey", "notation")


@query(f"""
SELECT p_partkey AS graph_id, {_CHAIN} + {_BRANCH} + 6 AS nodes, {_CHAIN} + {_BRANCH} + 6 AS bonds,
       6::BIGINT AS aromatic_bonds FROM part
""")
def notation_graph(spark, d):
    nodes, edges, _ = _part_graphs(spark, d)
    n = nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("nodes"))
    e = edges.filter("src < dst").groupBy("graph_id").agg(
        F.count(F.lit(1)).alias("bonds"), F.count_if(F.col("kind") == ":").alias("aromatic_bonds")
    )
    return n.join(dealt(e), "graph_id").select("graph_id", "nodes", "bonds", "aromatic_bonds")


@query(f"""
SELECT p_partkey AS graph_id, unnest(range({_CHAIN}, {_CHAIN} + {_BRANCH}))::BIGINT AS node_id, 'O' AS label FROM part
""")
def select_nodes(spark, d):
    nodes, _, _ = _part_graphs(spark, d)
    return G.select_nodes(nodes, 8).select("graph_id", "node_id", "label")


@query(f"""
SELECT p_partkey AS graph_id, (2 * {_CHAIN} + 6)::BIGINT AS hydrogens,
       ({_CHAIN} + {_BRANCH} + 6 + 2 * {_CHAIN} + 6)::BIGINT AS bonds FROM part
""")
def implicit_hydrogens(spark, d):
    nodes, edges, _ = _part_graphs(spark, d)
    all_nodes, all_edges = G.expand_implicit(nodes, edges)
    h = G.select_nodes(all_nodes, 1).groupBy("graph_id").agg(F.count(F.lit(1)).alias("hydrogens"))
    e = all_edges.filter("src < dst").groupBy("graph_id").agg(F.count(F.lit(1)).alias("bonds"))
    return h.join(dealt(e), "graph_id")


# Valid and invalid notations by part type, each with the size in it.
_MIXED = """CASE p_type WHEN 'STANDARD' THEN repeat('C', p_size) || 'O' WHEN 'ECONOMY' THEN 'C1' || repeat('C', p_size)
  WHEN 'MEDIUM' THEN 'C(' || repeat('N', p_size) WHEN 'PROMO' THEN repeat('C', p_size) || ')C'
  WHEN 'LARGE' THEN repeat('C', p_size) || 'X' ELSE repeat('C', p_size) || '=' END"""


@query("""
SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'valid' WHEN 'ECONOMY' THEN 'unclosed ring'
  WHEN 'MEDIUM' THEN 'unbalanced branch' WHEN 'PROMO' THEN 'misplaced branch, bond or ring mark'
  WHEN 'LARGE' THEN 'unknown token' ELSE 'misplaced branch, bond or ring mark' END AS outcome FROM part
""")
def screen_notation(spark, d):
    rows = _parts(spark, d, _MIXED)
    good, errors = Q.screen_notation(rows, "notation")
    return good.select("p_partkey", F.lit("valid").alias("outcome")).unionByName(
        errors.select("p_partkey", F.col("error").alias("outcome"))
    )


_ODD = """CASE p_type WHEN 'STANDARD' THEN repeat('C', p_size) || 'S(=O)(=O)C' WHEN 'ECONOMY' THEN '[Fe+2].[O-]' || repeat('C', p_size)
  WHEN 'MEDIUM' THEN repeat('C', p_size) || '[CH2]' WHEN 'PROMO' THEN repeat('C', 125 + p_size)
  WHEN 'LARGE' THEN repeat('C', p_size) || 'O' ELSE 'c1ccsc1' || repeat('C', p_size) END"""


@query("""
SELECT p_partkey AS graph_id, CASE p_type WHEN 'STANDARD' THEN p_size + 4 WHEN 'ECONOMY' THEN p_size + 2
    WHEN 'MEDIUM' THEN p_size + 1 WHEN 'PROMO' THEN p_size + 125 WHEN 'LARGE' THEN p_size + 1 ELSE p_size + 5 END::BIGINT AS heavy_atoms,
  CASE p_type WHEN 'STANDARD' THEN 'hyper-valent atom' WHEN 'ECONOMY' THEN 'transition metal, disconnected fragments'
    WHEN 'MEDIUM' THEN 'radical' WHEN 'PROMO' THEN CASE WHEN 125 + p_size > 150 THEN 'size' ELSE '' END ELSE '' END AS reasons
FROM part
""")
def graph_rules(spark, d):
    """Rules over node and edge aggregates of the graphs."""
    rows = _parts(spark, d, _ODD)
    nodes, edges, _ = G.notation_to_graph(rows, "p_partkey", "notation")
    metrics = Q.graph_metrics(nodes, edges).join(dealt(rows.withColumnRenamed("p_partkey", "graph_id")), "graph_id")
    flagged = Q.graph_rules(metrics, F.col("notation").contains("."))
    return flagged.select("graph_id", "heavy_atoms", F.array_join("reasons", ", ").alias("reasons"))


def conversation_graph(spark, d):
    """Turns as nodes labelled by role; consecutive turns are linked."""
    turns = table(spark, d, "conversations").select(
        F.col("conv_id").alias("graph_id"), F.col("turn").alias("node_id"), F.col("role").alias("label")
    )
    after = turns.select("graph_id", (F.col("node_id") - 1).alias("node_id"))
    links = turns.select("graph_id", "node_id").join(after, ["graph_id", "node_id"])
    one_way = links.select(
        "graph_id", F.col("node_id").alias("a"), (F.col("node_id") + 1).alias("b"), F.lit("-").alias("kind")
    )
    return turns, G.both_directions(one_way)


_HALVES = "('0x' || substr(h, 1, 15))::BIGINT AS a, ('0x' || substr(h, 16, 15))::BIGINT AS b"


_TURN_GRAPH = """t AS (SELECT conv_id AS g, turn AS n, role AS label FROM conversations),
links AS (SELECT x.g, x.n AS dst, y.n AS src FROM t x JOIN t y ON x.g = y.g AND abs(x.n - y.n) = 1)"""


def signature_sql(radius: int, typed: bool = False, graph: str = _TURN_GRAPH) -> str:
    """CTEs ``t``, ``links`` and ``s0 … s<radius>`` with the signatures of every node, by default of every turn."""
    parts = [
        graph,
        f"s0 AS (SELECT g, n, h, {_HALVES} FROM (SELECT g, n, md5(label) AS h FROM t))",
    ]
    for r in range(radius):
        if typed:
            sent = f"(SELECT g, n, {_HALVES} FROM (SELECT g, n, md5('-:' || a || ':' || b) AS h FROM s{r}))"
        else:
            sent = f"s{r}"
        parts.append(f"""s{r + 1} AS (SELECT g, n, h, {_HALVES} FROM (
  SELECT x.g, x.n, md5(x.a || '|' || x.b || '|' || count(y.a) || '|' || coalesce(sum(y.a), 0) || '|' || coalesce(sum(y.b), 0)) AS h
  FROM s{r} x LEFT JOIN links l ON l.g = x.g AND l.dst = x.n LEFT JOIN {sent} y ON y.g = l.g AND y.n = l.src
  GROUP BY x.g, x.n, x.a, x.b))""")
    return ",\n".join(parts)


@query(f"""
WITH {signature_sql(2)}
SELECT s0.g AS graph_id, s0.n AS node_id, substr(s0.h, 1, 30) AS sig_0, substr(s1.h, 1, 30) AS sig_1, substr(s2.h, 1, 30) AS sig_2
FROM s0 JOIN s1 USING (g, n) JOIN s2 USING (g, n)
""")
def circular_signatures(spark, d):
    nodes, edges = conversation_graph(spark, d)
    return G.circular_signatures(nodes, edges, 2)


@query("""
SELECT conv_id AS graph_id, turn AS node_id, substr(md5(CASE WHEN turn % 3 = 1 THEN '\\N' ELSE role END), 1, 30) AS sig_0, true AS around FROM conversations
""")
def null_labels_graph(spark, d):
    """Nodes without a label keep their place: each has a signature of every layer."""
    nodes, edges = conversation_graph(spark, d)
    nodes = nodes.withColumn("label", F.when(F.col("node_id") % 3 != 1, F.col("label")))
    found = G.circular_signatures(nodes, edges, 2)
    return found.select("graph_id", "node_id", "sig_0", (F.length("sig_1") + F.length("sig_2") == 60).alias("around"))


def bits_sql(signatures: str, key: str, k: int = 1, n_bits: int = 2048) -> str:
    """CTEs ``sigs``, ``bits`` and ``prints(key, bits)`` from a query for ``(key, sig)``."""
    each = " UNION ALL ".join(
        f"SELECT {key}, ('0x' || substr(md5(sig), {1 + 8 * j}, 8))::BIGINT % {n_bits} AS bit FROM sigs" for j in range(k)
    )
    return f"""sigs AS ({signatures}), bits AS ({each}),
prints AS (SELECT {key}, coalesce(bitstring_agg(bit, 0, {n_bits - 1})::VARCHAR, repeat('0', {n_bits})) AS bits FROM bits GROUP BY {key})"""


def _bitstring(words, key, n_bits=2048):
    return words.select(key, words_to_bitstring("words", n_bits).alias("bits"))


@query(f"""
WITH {signature_sql(2, typed=True)},
{bits_sql(" UNION ALL ".join(f"SELECT g AS graph_id, substr(h, 1, 30) AS sig FROM s{i}" for i in range(3)), "graph_id")}
SELECT * FROM prints
""")
def circular_fingerprint(spark, d):
    nodes, edges = conversation_graph(spark, d)
    return _bitstring(FP.circular_fingerprint(nodes, edges, 2, typed=True, dense=False), "graph_id")


_PATHS = """t AS (SELECT conv_id AS g, turn AS n, role AS label FROM conversations),
links AS (SELECT x.g, x.n AS src, y.n AS dst, y.label FROM t x JOIN t y ON x.g = y.g AND abs(x.n - y.n) = 1),
p AS (SELECT g, n, label AS fwd, label AS rev, [n] AS seen, 0 AS len FROM t
  UNION ALL SELECT p.g, l.dst, p.fwd || '>' || l.label, l.label || '>' || p.rev, list_append(p.seen, l.dst), p.len + 1
  FROM p JOIN links l ON l.g = p.g AND l.src = p.n WHERE p.len < 7 AND NOT list_contains(p.seen, l.dst))"""


@query(f"""
WITH RECURSIVE {_PATHS}, {bits_sql("SELECT DISTINCT g AS graph_id, CASE WHEN len >= 1 THEN least(fwd, rev) END AS sig FROM p", "graph_id", 2)}
SELECT * FROM prints
""")
def path_fingerprint(spark, d):
    nodes, edges = conversation_graph(spark, d)
    return _bitstring(FP.path_fingerprint(nodes, edges, dense=False), "graph_id")


@query("""
WITH RECURSIVE t AS (SELECT conv_id AS g, turn AS n FROM conversations),
links AS (SELECT x.g, x.n AS a, y.n AS b FROM t x JOIN t y ON x.g = y.g AND abs(x.n - y.n) = 1 WHERE least(x.n, y.n) % 3 <> 0),
r AS (SELECT g, n, n AS top FROM t UNION SELECT r.g, l.b, r.top FROM r JOIN links l ON l.g = r.g AND l.a = r.n)
SELECT g AS graph_id, count(*) AS fragments FROM (SELECT g, n FROM r GROUP BY g, n HAVING min(top) = n) GROUP BY g
""")
def graph_fragments(spark, d):
    """Parts of every conversation with each third link removed."""
    nodes, edges = conversation_graph(spark, d)
    return FR.graph_fragments(nodes, edges.filter(F.least("src", "dst") % 3 != 0))


# The graphs of _NOTATION, stated by their sizes: chain atoms first, then the branch, then the ring.
_PART_GRAPH = f"""pg AS (SELECT p_partkey AS g, {_CHAIN}::BIGINT AS c, {_BRANCH}::BIGINT AS k FROM part),
t AS (SELECT g, n, CASE WHEN n >= c AND n < c + k THEN 'O' ELSE 'C' END AS label FROM (SELECT *, unnest(range(0, c + k + 6)) AS n FROM pg)),
bonds AS (SELECT g, i AS a, i + 1 AS b, '-' AS kind FROM (SELECT g, unnest(range(0, c + k - 1)) AS i FROM pg)
  UNION ALL SELECT g, c - 1, c + k, '-' FROM pg
  UNION ALL SELECT g, i, i + 1, ':' FROM (SELECT g, unnest(range(c + k, c + k + 5)) AS i FROM pg)
  UNION ALL SELECT g, c + k, c + k + 5, ':' FROM pg),
links AS (SELECT g, a AS src, b AS dst FROM bonds UNION ALL SELECT g, b, a FROM bonds)"""


def _sets_sql(max_len: int) -> str:
    """CTEs up to ``codes(graph_id, code)``, one row for each connected set of bonds."""
    return f"""{_PART_GRAPH},
e AS (SELECT x.*, a * 1000 + b AS id, p.label AS la, q.label AS lb FROM bonds x JOIN t p ON p.g = x.g AND p.n = x.a JOIN t q ON q.g = x.g AND q.n = x.b),
s AS (SELECT g, [id] AS ids, list_sort([a, b]) AS ends FROM e
  UNION SELECT s.g, list_sort(list_append(ids, e.id)), list_sort(list_distinct(list_concat(ends, [e.a, e.b])))
  FROM s JOIN e ON e.g = s.g WHERE len(ids) < {max_len} AND NOT list_contains(ids, e.id) AND (list_contains(ends, e.a) OR list_contains(ends, e.b))),
m AS (SELECT u.g, u.ids, e.a, e.b, e.kind, e.la, e.lb, e.id FROM (SELECT g, ids, unnest(ids) AS id FROM s) u JOIN e ON e.g = u.g AND e.id = u.id),
atom AS (SELECT g, ids, n, any_value(own) || '(' || string_agg(far, ',' ORDER BY far) || ')' AS txt FROM (
  SELECT g, ids, a AS n, la AS own, kind || lb AS far FROM m UNION ALL SELECT g, ids, b, lb, kind || la FROM m) GROUP BY g, ids, n),
codes AS (SELECT m.g AS graph_id, string_agg(least(x.txt, y.txt) || kind || greatest(x.txt, y.txt), ';' ORDER BY least(x.txt, y.txt) || kind || greatest(x.txt, y.txt)) AS code
  FROM m JOIN atom x ON x.g = m.g AND x.ids = m.ids AND x.n = m.a JOIN atom y ON y.g = m.g AND y.ids = m.ids AND y.n = m.b GROUP BY m.g, m.ids)"""


@query(f"WITH RECURSIVE {_sets_sql(5)} SELECT graph_id, code, count(*) AS n FROM codes GROUP BY ALL")
def branched_keys(spark, d):
    """All connected sets of up to five bonds, grown in the row of a notation."""
    keys, _, _ = SG.notation_branched_keys(_parts(spark, d, _NOTATION), "p_partkey", "notation", 1, 5)
    return keys


@query(f"WITH RECURSIVE {_sets_sql(3)} SELECT graph_id, code, count(*) AS n FROM codes GROUP BY ALL")
def branched_keys_tables(spark, d):
    """The same from node and edge tables, by joins."""
    nodes, edges, _ = _part_graphs(spark, d)
    return SG.branched_keys(nodes, edges, 1, 3)


@query(f"""
WITH RECURSIVE {_sets_sql(5)}, {bits_sql("SELECT DISTINCT graph_id, code AS sig FROM codes", "graph_id", 2)} SELECT * FROM prints
""")
def branched_fingerprint(spark, d):
    words, _ = SG.notation_branched_fingerprint(_parts(spark, d, _NOTATION), "p_partkey", "notation", 1, 5, dense=False)
    return _bitstring(words, "graph_id")


@query(f"""
WITH {signature_sql(2, graph=_PART_GRAPH)},
near AS (SELECT g, n, n AS at, 0 AS steps FROM t UNION ALL SELECT g, dst, src, 1 FROM links),
within AS (SELECT r.g, r.n, x.a, x.b, min(steps) + 1 AS first FROM near r JOIN bonds x ON x.g = r.g AND r.at IN (x.a, x.b) GROUP BY ALL),
env AS (SELECT w.g, w.n, r AS radius, list_sort(list((a, b)) FILTER (WHERE first <= r)) AS held FROM within w, range(1, 3) o(r) GROUP BY ALL),
named AS (SELECT v.g, v.radius, v.held, substr(CASE v.radius WHEN 1 THEN s1.h ELSE s2.h END, 1, 30) AS sig
  FROM env v JOIN s1 ON s1.g = v.g AND s1.n = v.n JOIN s2 ON s2.g = v.g AND s2.n = v.n),
kept AS (SELECT g, 0 AS radius, substr(h, 1, 30) AS sig FROM s0
  UNION ALL SELECT g, radius, sig FROM (SELECT *, row_number() OVER (PARTITION BY g, held ORDER BY radius, sig) AS i FROM named) WHERE i = 1)
SELECT g AS graph_id, radius::INTEGER AS radius, sig, count(*) AS n FROM kept GROUP BY ALL
""")
def circular_environments(spark, d):
    """Surroundings up to radius 2; those over the same bonds are counted once."""
    found, _ = SG.notation_circular_environments(_parts(spark, d, _NOTATION), "p_partkey", "notation", 2)
    return found


@query("""
WITH RECURSIVE t AS (
  SELECT r_regionkey AS g, 'r' || r_regionkey AS n, r_name AS label FROM region UNION ALL
  SELECT n_regionkey, 'n' || n_nationkey, n_name FROM nation UNION ALL
  SELECT n_regionkey, 'c' || c_custkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL
  SELECT n_regionkey, 's' || s_suppkey, 'SUPPLIER' FROM supplier JOIN nation ON s_nationkey = n_nationkey),
l1 AS (
  SELECT n_regionkey AS g, 'r' || n_regionkey AS a, 'n' || n_nationkey AS b FROM nation UNION ALL
  SELECT n_regionkey, 'n' || n_nationkey, 'c' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL
  SELECT n_regionkey, 'n' || n_nationkey, 's' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
links AS (SELECT e.g, e.src, e.dst, t.label FROM (SELECT g, a AS src, b AS dst FROM l1 UNION ALL SELECT g, b, a FROM l1) e
  JOIN t ON t.g = e.g AND t.n = e.dst),
p AS (SELECT g, n, label AS fwd, label AS rev, [n] AS seen, 0 AS len FROM t
  UNION ALL SELECT p.g, l.dst, p.fwd || '>' || l.label, l.label || '>' || p.rev, list_append(p.seen, l.dst), p.len + 1
  FROM p JOIN links l ON l.g = p.g AND l.src = p.n WHERE p.len < 7 AND NOT list_contains(p.seen, l.dst))
SELECT DISTINCT g AS graph_id, least(fwd, rev) AS path FROM p WHERE len >= 1
""")
def path_keys_hubs(spark, d):
    """Label paths in graphs with hubs: a region, its nations, their customers and suppliers."""
    nation = table(spark, d, "nation").select(
        F.col("n_regionkey").alias("graph_id"), "n_nationkey", "n_name"
    )
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    c = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    s = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    root = table(spark, d, "region").select(F.col("r_regionkey").alias("graph_id"), "r_name")

    def node(df, node_id, label):
        return df.select("graph_id", node_id.alias("node_id"), label.alias("label"))

    def link(df, a, b):
        return df.select("graph_id", a.alias("a"), b.alias("b"), F.lit("-").alias("kind"))

    at = {"r": tag("r", "graph_id"), "n": tag("n", "n_nationkey"),
          "c": tag("c", "c_custkey"), "s": tag("s", "s_suppkey")}
    nodes = (
        node(root, at["r"], F.col("r_name"))
        .unionByName(node(nation, at["n"], F.col("n_name")))
        .unionByName(node(c, at["c"], F.col("c_mktsegment")))
        .unionByName(node(s, at["s"], F.lit("SUPPLIER")))
    )
    one_way = (
        link(nation, at["r"], at["n"])
        .unionByName(link(c, at["n"], at["c"]))
        .unionByName(link(s, at["n"], at["s"]))
    )
    return FP.path_keys(nodes, G.both_directions(one_way), 1, 7)


_RUNS = " UNION ".join("SELECT doc_id, " + " || ' ' || ".join(f"a{k}" for k in range(n)) + " AS sig FROM g" for n in range(1, 8))
_NGRAMS = f"""l AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS a0, generate_subscripts(words, 1) AS i FROM l),
g AS (SELECT doc_id, a0, {", ".join(f"lead(a0, {k}) OVER o AS a{k}" for k in range(1, 7))} FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
{bits_sql(_RUNS + " UNION SELECT doc_id, NULL FROM documents", "doc_id")}"""


def _ngram_words(spark, d):
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    docs = spread(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", words.alias("words")
    )
    return FP.ngram_fingerprint(docs, "doc_id", "words", 1, 7, dense=False)


@query(f"WITH {_NGRAMS} SELECT * FROM prints")
def ngram_fingerprint(spark, d):
    return _bitstring(_ngram_words(spark, d), "doc_id")


@query(f"""
WITH {_NGRAMS} SELECT p.doc_id AS name, quality AS label, bits FROM prints p JOIN labels USING (doc_id) WHERE quality IS NOT NULL
""")
def fingerprint_labeled(spark, d):
    """Word runs of the documents as a labelled matrix."""
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("name"), "quality")
    matrix = fingerprint_matrix(_ngram_words(spark, d), labels, key="doc_id", label="quality")
    bits = F.array_join(F.col("features").cast("array<string>"), "")
    return matrix.select("name", "label", bits.alias("bits"))


_LEVELS = [["p_brand"], ["p_brand", "p_size"], ["p_brand", "p_size", "p_type"]]


def _priced_parts(spark, d):
    price = F.col("p_retailprice").cast("decimal(18,2)").alias("price")
    return table(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_type", price)


def _stats(level: int, key: str, extra: str = "") -> str:
    return f"""SELECT {extra} {level} AS level, {key} AS key, min(v)::DOUBLE AS min, sum(v)::DOUBLE / count(*) AS mean,
  max(v)::DOUBLE AS max, count(*) AS n FROM src GROUP BY ALL"""


_PART_TABLE = f"""src AS (SELECT *, p_retailprice::DECIMAL(18,2) AS v FROM part),
fit AS ({_stats(1, "p_brand")} UNION ALL {_stats(2, "p_brand || chr(31) || p_size")}
  UNION ALL {_stats(3, "p_brand || chr(31) || p_size || chr(31) || p_type")})"""


@query(f"WITH {_PART_TABLE} SELECT * FROM fit")
def backoff_fit(spark, d):
    return B.fit_backoff(_priced_parts(spark, d), _LEVELS, "price")


@query(f"WITH {_PART_TABLE} SELECT * FROM fit")
def backoff_merged(spark, d):
    """Tables fitted on four fifths and on one fifth of the parts, merged: the table of all parts."""
    parts = _priced_parts(spark, d)
    old, new = (B.fit_backoff(parts.filter(rows), _LEVELS, "price", mergeable=True) for rows in ("p_partkey % 5 <> 0", "p_partkey % 5 = 0"))
    return B.merge_backoff(old, new).drop("total")


@query(f"""
WITH {_PART_TABLE}
SELECT p_partkey, coalesce(c.mean, b.mean, a.mean) AS predicted, coalesce(c.min, b.min, a.min) AS lo,
  coalesce(c.max, b.max, a.max) AS hi, coalesce(c.n, b.n, a.n) AS support, coalesce(c.level, b.level, a.level) AS level
FROM part
LEFT JOIN fit a ON a.level = 1 AND a.n >= 3 AND a.key = p_brand
LEFT JOIN fit b ON b.level = 2 AND b.n >= 3 AND b.key = p_brand || chr(31) || p_size
LEFT JOIN fit c ON c.level = 3 AND c.n >= 3 AND c.key = p_brand || chr(31) || p_size || chr(31) || p_type
""")
def backoff_predict(spark, d):
    parts = _priced_parts(spark, d)
    fitted = stage(B.fit_backoff(parts, _LEVELS, "price"), "fit")
    answers = B.predict_backoff(parts, fitted, _LEVELS, min_support=3)
    return answers.select("p_partkey", "predicted", "lo", "hi", "support", "level")


@query("""
WITH src AS (SELECT *, l_extendedprice::DECIMAL(18,2) AS v FROM lineitem WHERE l_returnflag = 'R'),
a AS (SELECT l_quantity, sum(v)::DOUBLE / count(*) AS mean, count(*) AS n FROM src GROUP BY ALL HAVING count(*) >= 10),
b AS (SELECT l_quantity, l_discount, sum(v)::DOUBLE / count(*) AS mean, count(*) AS n FROM src GROUP BY ALL HAVING count(*) >= 10)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(b.mean, a.mean) AS predicted, coalesce(b.n, a.n) AS support,
  CASE WHEN b.n IS NOT NULL THEN 2 WHEN a.n IS NOT NULL THEN 1 END AS level
FROM lineitem l LEFT JOIN a ON a.l_quantity = l.l_quantity
LEFT JOIN b ON b.l_quantity = l.l_quantity AND b.l_discount = l.l_discount
""")
def backoff_conditions(spark, d):
    """The table is fitted per condition; the lookup uses the part for one of them."""
    levels = [["l_quantity"], ["l_quantity", "l_discount"]]
    items = table(spark, d, "lineitem").withColumn("v", F.col("l_extendedprice").cast("decimal(18,2)"))
    fitted = stage(B.fit_backoff(items, levels, "v", conditions=["l_returnflag"]), "fit")
    answers = B.predict_backoff(items, fitted, levels, 10, {"l_returnflag": "R"})
    return answers.select("l_orderkey", "l_linenumber", "l_partkey", "predicted", "support", "level")
