"""Notation, signatures, fingerprints and back-off."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from featureloom import (
    both_directions, circular_fingerprint, circular_signatures, expand_implicit, fit_backoff, fold_bits, graph_metrics, graph_rules,
    ngram_fingerprint, notation_paths, notation_to_graph, path_fingerprint, path_keys,
    predict_backoff, screen_notation, select_nodes,
)
from featureloom.functions.families import representatives
from featureloom.functions.vectors import set_bits, words_to_bitstring, words_to_vector

VALID = {"CCO": (3, 2), "c1ccccc1": (6, 6), "[Na+].[Cl-]": (2, 0), "C%12CCCC%12": (5, 5),
         "F/C=C/F": (4, 3), "C[C@H](N)C(=O)O": (6, 5), "C": (1, 0),
         "CC1(C)OB(c2ccc(C[C@@H](N)C#N)nc2)OC1=S": (19, 20)}
INVALID = ["C1CC", "C(C", "CC)", "CXC", "C=", "C==C", "C()C", "C11", "C1C1", "[Xx]C", "(C)C", ".C", "C..C"]


def frame(spark, notations):
    return spark.createDataFrame(list(enumerate(notations)), "id int, s string")


def test_notation(spark):
    names = [*VALID, *INVALID]
    nodes, edges, errors = notation_to_graph(frame(spark, names), "id", "s")
    n = {r.graph_id: r["count"] for r in nodes.groupBy("graph_id").count().collect()}
    e = {r.graph_id: r["count"] for r in edges.groupBy("graph_id").count().collect()}
    for i, s in enumerate(VALID):
        assert (n[i], e.get(i, 0) // 2) == VALID[s], s
    assert {r.notation for r in errors.collect()} == set(INVALID)
    good, bad = screen_notation(frame(spark, names), "s")
    assert good.count() == len(VALID) and bad.count() == len(INVALID)


def test_atom_fields_and_hydrogens(spark):
    names = ["CCO", "c1ccccc1", "[NH4+]", "c1cc[nH]c1", "CS(=O)(=O)C", "[13CH3:2]C", "OP(=O)(O)O"]
    nodes, edges, _ = notation_to_graph(frame(spark, names), "id", "s")
    by = {(r.graph_id, r.node_id): r for r in nodes.collect()}
    assert (by[2, 0].label, by[2, 0].charge, by[2, 0].explicit_h) == ("N", 1, 4)
    assert by[3, 3].aromatic and by[3, 3].explicit_h == 1
    all_nodes, all_edges = expand_implicit(nodes, edges)
    h = {r.graph_id: r["count"] for r in select_nodes(all_nodes, 1).groupBy("graph_id").count().collect()}
    assert h == {0: 6, 1: 6, 2: 4, 3: 5, 4: 6, 5: 6, 6: 3}
    assert all_nodes.groupBy("graph_id", "node_id").count().filter("count > 1").isEmpty()


def test_graph_rules(spark):
    names = ["CCO", "CS(=O)(=O)C", "[Fe+2].[Cl-]", "[CH3]", "C" * 151, "CSC"]
    df = frame(spark, names)
    nodes, edges, _ = notation_to_graph(df, "id", "s")
    m = graph_metrics(nodes, edges).join(df.withColumnRenamed("id", "graph_id"), "graph_id")
    got = {r.graph_id: r.reasons for r in graph_rules(m, F.col("s").contains(".")).collect()}
    assert got == {0: [], 1: ["hyper-valent atom"], 2: ["transition metal", "disconnected fragments"],
                   3: ["radical"], 4: ["size"], 5: []}


def test_signatures_do_not_depend_on_numbering(spark):
    rng = random.Random(7)
    links = {tuple(sorted(rng.sample(range(12), 2))) for _ in range(18)}
    def tables(perm):
        nodes = spark.createDataFrame([(1, perm[i], "CNO"[i % 3]) for i in range(12)], "graph_id int, node_id bigint, label string")
        both = [(1, perm[a], perm[b], "-") for x, y in links for a, b in ((x, y), (y, x))]
        return nodes, spark.createDataFrame(both, "graph_id int, src bigint, dst bigint, kind string")
    perm = rng.sample(range(100), 12)
    a = {r.node_id: r.sig_2 for r in circular_signatures(*tables(list(range(12)))).collect()}
    b = {r.node_id: r.sig_2 for r in circular_signatures(*tables(perm)).collect()}
    assert len(a) == 12 and {perm[i]: s for i, s in a.items()} == b


def brute_paths(labels, links, max_len):
    near = {}
    for a, b in links:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    found = set()
    def go(path):
        if len(path) > 1:
            text = [labels[i] for i in path]
            found.add(min(">".join(text), ">".join(text[::-1])))
        if len(path) <= max_len:
            for n in near.get(path[-1], []):
                if n not in path:
                    go([*path, n])
    for i in range(len(labels)):
        go([i])
    return found


@pytest.mark.parametrize("hub_degree", [2, 100])
def test_paths_with_and_without_thinning(spark, hub_degree):
    """Thinning at nodes with many edges must not lose any path text."""
    rng = random.Random(3)
    labels = [rng.choice("ab") for _ in range(9)]
    links = {tuple(sorted(rng.sample(range(9), 2))) for _ in range(14)}
    nodes = spark.createDataFrame([(1, i, x) for i, x in enumerate(labels)], "graph_id int, node_id bigint, label string")
    both = [(1, a, b, "-") for x, y in links for a, b in ((x, y), (y, x))]
    edges = spark.createDataFrame(both, "graph_id int, src bigint, dst bigint, kind string")
    got = {r.path for r in path_keys(nodes, edges, 1, 4, hub_degree=hub_degree).collect()}
    assert got == brute_paths(labels, links, 4)


def test_representatives():
    rng = random.Random(1)
    for _ in range(200):
        sets = [frozenset(rng.sample(range(8), 3)) for _ in range(12)]
        room = rng.randint(0, 3)
        kept = [sets[i] for i in representatives(sets, room)]
        for ahead in itertools.combinations(range(8), room):
            free = any(not s & set(ahead) for s in sets)
            assert free == any(not s & set(ahead) for s in kept)
    stars = [frozenset([0, i]) for i in range(1, 5000)]
    assert len(representatives(stars, 3)) <= 1 + 2 + 4 + 8


def test_notation_paths_agree_with_joins(spark):
    df = frame(spark, [*VALID, "C(C)(C)(C)(C)(C)(C)(C)(C)(C)(N)O", "C1CC"])
    pairs = lambda d: sorted((r.graph_id, tuple(r.words)) for r in d.collect())
    in_row, errors = notation_paths(df, "id", "s", max_len=4, dense=False)
    mixed, _ = notation_paths(df, "id", "s", max_len=4, dense=False, max_walks=100)
    nodes, edges, _ = notation_to_graph(df, "id", "s")
    joined = path_fingerprint(nodes, edges, max_len=4, typed=True, dense=False)
    assert pairs(in_row) == pairs(mixed) == pairs(joined)
    assert len(pairs(in_row)) == len(VALID) + 1 and errors.count() == 1


def test_words(spark):
    bits = [0, 1, 63, 64, 100, 127, 255]
    df = spark.createDataFrame([("k", str(i)) for i in range(300)], "k string, s string")
    for n in (100, 256, 5000):
        r = fold_bits(df, "k", "s", n, dense=False).select(
            words_to_vector("words", n), words_to_bitstring("words", n), set_bits("words", n)
        ).first()
        assert len(r[0]) == n and set(r[0]) <= {0, 1}
        assert "".join(map(str, r[0])) == r[1]
        assert [i for i, b in enumerate(r[0]) if b] == r[2]
    word = spark.range(1).select(F.array(*[
        F.lit(sum((1 << b % 64) for b in bits if b // 64 == w) - (1 << 64 if w in (0, 1, 3) else 0)).cast("bigint")
        for w in range(4)
    ]).alias("w")).select(set_bits("w", 256)).first()[0]
    assert word == bits


def test_ngrams(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, []), (3, ["a"])], "id int, t array<string>")
    got = {r.id: sum(r.features) for r in ngram_fingerprint(df, "id", "t", 1, 3, 1 << 12).collect()}
    assert got == {1: 6, 2: 0, 3: 1}


@pytest.mark.parametrize("n_bits, per, low, high", [(2048, 1, 1, 7), (100, 3, 2, 4), (5000, 4, 1, 2)])
def test_token_runs_without_a_row_for_each(spark, n_bits, per, low, high):
    """The bits of every run as a row with a text of its own, and none of these rows."""
    from featureloom.operators.fingerprints import fold_bits, ngrams

    odd = [
        ["a", "b", "c", "d", "e", "f", "g", "h"], [], None, [None], [None, "a", None, "", "b", None, None], ["", "", ""], ["é ß", "x" * 55, "y" * 56, "z" * 700],
        ["w"] * 63 + ["", None, "q"], ["a b", "c"], ["b", "c"],
    ]
    many = [[f"w{i * j % 97}" for j in range(i)] for i in range(1, 60)]
    df = spark.createDataFrame([(i % 60, t) for i, t in enumerate([*odd, *many, *odd])], "k int, t array<string>").repartition(3)
    rows = df.select("k", F.explode_outer(ngrams("t", low, high)).alias("gram"))
    want = {r.k: list(r.words) for r in fold_bits(rows, "k", "gram", n_bits, per, dense=False).collect()}
    got = ngram_fingerprint(df, "k", "t", low, high, n_bits, per, dense=False)
    assert {r.k: list(r.words) for r in got.collect()} == want and len(want) == 60
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert n_bits > 4096 or "Generate" not in plan


def test_backoff(spark):
    train = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "x", 3.0), ("a", "y", 8.0), ("b", None, 5.0), ("b", "", 7.0), ("c", "x", None)],
        "p string, q string, v double",
    )
    levels = [["p"], ["p", "q"]]
    fitted = fit_backoff(train, levels, "v")
    assert fitted.count() == 2 + 4
    ask = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", None), ("d", "x")], "p string, q string")
    got = {(r.p, r.q): (r.predicted, r.level, r.support) for r in predict_backoff(ask, fitted, levels).collect()}
    assert got == {("a", "x"): (2.0, 2, 2), ("a", "z"): (4.0, 1, 3), ("b", None): (5.0, 2, 1), ("d", "x"): (None, None, None)}
    strict = predict_backoff(ask, fitted, levels, min_support=3).filter("level IS NOT NULL").collect()
    assert {(r.p, r.q) for r in strict} == {("a", "x"), ("a", "z")}


def test_hub_thinning_keeps_every_path_text(spark):
    """Labels may hold the separator: then one direction of a text does not give the other."""
    labels = {0: "h", 1: "y>x", 2: "w", 3: "y", 4: "x>w", **{k: f"l{k}" for k in range(5, 12)}}
    links = [(1, 2), (3, 4), (2, 0), (4, 0), *[(0, k) for k in range(5, 12)]]
    nodes = spark.createDataFrame([(1, k, v) for k, v in labels.items()], "graph_id int, node_id int, label string")
    edges = both_directions(spark.createDataFrame([(1, a, b, "-") for a, b in links], "graph_id int, a int, b int, kind string"))
    found = [sorted(r.path for r in path_keys(nodes, edges, 1, 4, hub_degree=h).collect()) for h in (2, 8, 10_000)]
    assert found[0] == found[1] == found[2]


def test_null_labels_keep_their_nodes(spark):
    nodes = spark.createDataFrame([(1, 0, "a"), (1, 1, None), (2, 0, None)], "graph_id int, node_id int, label string")
    edges = both_directions(spark.createDataFrame([(1, 0, 1, "-")], "graph_id int, a int, b int, kind string"))
    found = circular_signatures(nodes, edges, 2).collect()
    assert len(found) == 3 and all(r.sig_2 for r in found)
    assert {r.graph_id for r in circular_fingerprint(nodes, edges).collect()} == {1, 2}
    assert {r.graph_id for r in path_fingerprint(nodes, edges).collect()} == {1, 2}


def test_many_hydrogens_have_ids_of_their_own(spark):
    nodes, edges, _ = notation_to_graph(frame(spark, ["[CH20]C"]), "id", "s")
    every, _ = expand_implicit(nodes, edges)
    ids = [r.node_id for r in every.collect()]
    assert len(ids) == len(set(ids)) > 20


def test_exploded_tables_are_not_broadcast(spark):
    """Staged graphs take a few bytes in their files and far more as rows: their joins go by key, not through the driver."""
    from featureloom.operators.assembly import attach_labels
    from featureloom.operators.fragments import node_fragments
    from featureloom.operators.subgraphs import branched_keys, circular_environments

    rows = spark.range(2000).selectExpr("id AS k", "'CC(O)Cc1ccccc1' AS notation")
    nodes, edges, _ = notation_to_graph(rows, "k", "notation")
    labels = nodes.filter("node_id = 0").selectExpr("graph_id", "1 AS label")
    built = {
        "metrics": graph_metrics(nodes, edges), "expanded": expand_implicit(nodes, edges)[0],
        "signatures": circular_signatures(nodes, edges, 2), "fragments": node_fragments(nodes, edges),
        "sets": branched_keys(nodes, edges, 1, 2), "environments": circular_environments(nodes, edges, 2),
        "labels": attach_labels(nodes.drop("label"), labels, "graph_id", "label", keep_unlabelled=True),
    }
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    sent = [name for name, df in built.items() if "Broadcast" in str(df._jdf.queryExecution().executedPlan().toString())]
    assert sent == []
    assert built["metrics"].select("heavy_atoms").distinct().collect() == [(10,)]


def test_like_leaves_of_a_hub_are_two(spark):
    """Two leaves of one label at a node give all path texts: paths do not grow with the leaves of a hub."""
    from featureloom.operators import fingerprints as FP

    # Two hubs with 40 leaves each, linked through 2; 90 is a leaf of 2, 91 is linked twice, 92 has a leaf of its own, 94 is no node.
    leaves = [(h, 100 * h + k, ["x", "y", "z", None][k % 4]) for h in (1, 3) for k in range(40)]
    nodes = spark.createDataFrame([(1, n, v) for n, v in [(1, "h"), (2, "m"), (3, "h"), (90, "x"), (91, "x"), (92, "u"), (93, "u"), *[(n, v) for _, n, v in leaves]]],
                                  "graph_id int, node_id int, label string")
    links = [(1, 2, "-"), (2, 3, "-"), (2, 90, "="), (1, 91, "-"), (1, 91, "="), (3, 92, "-"), (92, 93, "-"), (1, 94, "-"),
             *[(h, n, "=" if n % 4 == 1 else "-") for h, n, _ in leaves]]
    edges = both_directions(spark.createDataFrame([(1, a, b, k) for a, b, k in links], "graph_id int, a int, b int, kind string"))
    for typed in (False, True):
        found = [{r.path for r in path_keys(nodes, edges, 0, 6, typed=typed, hub_degree=h).collect()} for h in (8, 10_000)]
        assert found[0] == found[1]
    kept = FP._without_like_leaves(nodes, edges, F.coalesce("label", F.lit("")), F.lit(">"))
    assert kept.filter("src = 1").count() <= 2 * 4 + 5
    assert kept.count() == kept.selectExpr("graph_id", "dst AS src", "src AS dst", "kind").intersectAll(kept.select("graph_id", "src", "dst", "kind")).count()
