"""Sets of bonds and environments against plain enumeration."""

import itertools
import random
from collections import Counter

import pytest

from featureloom import (
    both_directions, branched_fingerprint, branched_keys, circular_environments, notation_branched_keys, notation_to_graph,
)

NAMES = ["C", "CC", "CC(C)(C)C", "C1CC1C", "c1ccc2ccccc2c1", "CC1(C)OB(c2ccnc2)OC1=S", "[Na+].[Cl-]", "S(=O)(=O)(N)O", "C1CC2CCC1C2"]


def plain_code(bonds, labels):
    def node(x):
        return labels[x] + "(" + ",".join(sorted(k + labels[b if a == x else a] for a, b, k in bonds if x in (a, b))) + ")"

    return ";".join(sorted(k.join(sorted((node(a), node(b)))) for a, b, k in bonds))


def connected(bonds):
    reached, rest = set(bonds[0][:2]), list(bonds[1:])
    while near := [e for e in rest if reached & set(e[:2])]:
        reached.update(*(e[:2] for e in near))
        rest = [e for e in rest if e not in near]
    return not rest


def plain_keys(bonds, labels, low, high):
    return Counter(
        plain_code(s, labels) for k in range(low, high + 1) for s in itertools.combinations(bonds, k) if connected(s)
    )


def graphs_of(nodes, edges):
    labels, bonds = {}, {}
    for r in nodes.collect():
        labels.setdefault(r.graph_id, {})[r.node_id] = r.label or ""
    for r in edges.filter("src < dst").collect():
        bonds.setdefault(r.graph_id, []).append((r.src, r.dst, r.kind))
    return labels, bonds


def counted(keys):
    out = {}
    for r in keys.collect():
        assert r.code not in out.setdefault(r.graph_id, Counter())
        out[r.graph_id][r.code] = r.n
    return out


@pytest.mark.parametrize("low,high", [(1, 1), (2, 5)])
def test_sets_of_notations(spark, low, high):
    rows = spark.createDataFrame(list(enumerate([*NAMES, "C1C"])), "id int, s string")
    nodes, edges, _ = notation_to_graph(rows, "id", "s")
    labels, bonds = graphs_of(nodes, edges)
    want = {g: plain_keys(b, labels[g], low, high) for g, b in bonds.items()}
    want = {g: w for g, w in want.items() if w}
    keys, graphs, errors = notation_branched_keys(rows, "id", "s", low, high)
    assert counted(keys) == want
    assert [r.name for r in errors.collect()] == [len(NAMES)]
    assert sorted(r.graph_id for r in graphs.collect()) == list(range(len(NAMES)))
    # Every row by joins, by the one bound and by the other.
    assert counted(notation_branched_keys(rows, "id", "s", low, high, max_bonds=0)[0]) == want
    assert counted(notation_branched_keys(rows, "id", "s", low, high, max_walks=8)[0]) == want


def test_sets_of_tables(spark):
    """Loops, repeated links, links to no node, null labels and ids that are texts."""
    nodes = spark.createDataFrame([("g", x, l) for x, l in zip("abcd", ["A", None, "B", "A"])] + [("h", "a", "A")], "graph_id string, node_id string, label string")
    links = [("g", "a", "b", "-"), ("g", "b", "c", "-"), ("g", "c", "d", "="), ("g", "b", "d", "-"), ("g", "a", "b", "-"), ("g", "a", "a", "-"), ("g", "a", "z", "-")]
    edges = both_directions(spark.createDataFrame(links, "graph_id string, a string, b string, kind string"))
    kept = [e[1:] for e in links[:4]]
    want = {"g": plain_keys(kept, {"a": "A", "b": "", "c": "B", "d": "A"}, 1, 4)}
    assert counted(branched_keys(nodes, edges, 1, 4)) == want
    untyped = {"g": plain_keys([(a, b, ">") for a, b, _ in kept], {"a": "A", "b": "", "c": "B", "d": "A"}, 1, 4)}
    assert counted(branched_keys(nodes, edges, 1, 4, typed=False)) == untyped
    assert branched_keys(nodes.limit(0), edges.limit(0)).count() == 0
    prints = branched_fingerprint(branched_keys(nodes, edges), nodes.select("graph_id").distinct())
    bits = {r.graph_id: sum(r.features) for r in prints.collect()}
    assert bits["h"] == 0 < bits["g"]
    with pytest.raises(ValueError):
        branched_keys(nodes, edges, 0, 3)


def test_branches_change_the_fingerprint(spark):
    """Two trees with the same labelled paths of each length can still differ in their branches."""
    rows = spark.createDataFrame([(0, "CC(C)(C)C"), (1, "CC(C)CC"), (2, "C(C)(C)(C)C")], "id int, s string")
    keys, graphs, _ = notation_branched_keys(rows, "id", "s")
    prints = {r.graph_id: tuple(r.features) for r in branched_fingerprint(keys, graphs).collect()}
    assert prints[0] == prints[2] != prints[1]


def plain_environments(nodes, bonds, sigs, radius):
    out = Counter()
    held = {}
    for v in nodes:
        out[(0, sigs[v][0])] += 1
        near, taken = {v}, set()
        for r in range(1, radius + 1):
            taken = taken | {e for e in bonds if near & set(e)}
            near = near | {x for e in taken for x in e}
            if taken:
                key = frozenset(taken)
                held[key] = min(held.get(key, (r, sigs[v][r])), (r, sigs[v][r]))
    out.update(held.values())
    return out


def test_environments(spark):
    from featureloom import circular_signatures

    rows = spark.createDataFrame(list(enumerate(NAMES)), "id int, s string")
    nodes, edges, _ = notation_to_graph(rows, "id", "s")
    _, bonds = graphs_of(nodes, edges)
    sigs = {}
    for r in circular_signatures(nodes, edges, 3).collect():
        sigs.setdefault(r.graph_id, {})[r.node_id] = [r[f"sig_{i}"] for i in range(4)]
    got = {}
    for r in circular_environments(nodes, edges, 3).collect():
        got.setdefault(r.graph_id, Counter())[(r.radius, r.sig)] = r.n
    for g, of in sigs.items():
        assert got[g] == plain_environments(of, [e[:2] for e in bonds.get(g, [])], of, 3), NAMES[g]


def test_environments_do_not_depend_on_node_numbers(spark):
    rng = random.Random(3)
    links = [(0, 1), (1, 2), (2, 3), (1, 4), (4, 5), (5, 1), (2, 6)]
    number = list(range(7))
    found = []
    for _ in range(2):
        nodes = spark.createDataFrame([(0, number[x], "XY"[x % 2]) for x in range(7)], "graph_id int, node_id int, label string")
        edges = both_directions(spark.createDataFrame([(0, number[a], number[b], "-") for a, b in links], "graph_id int, a int, b int, kind string"))
        found.append(sorted(map(tuple, circular_environments(nodes, edges, 2).collect())))
        rng.shuffle(number)
    assert found[0] == found[1]
    only = circular_environments(nodes, edges, 0)
    assert sum(r.n for r in only.collect()) == 7


def test_equal_notations_are_grown_once(spark, monkeypatch):
    """Rows of one notation share the work, in groups of bounded size; each key keeps its row, also a null or repeated one."""
    from featureloom.operators import graph, rowgraphs, subgraphs
    from featureloom.operators.rowgraphs import notation_paths
    from featureloom.operators.subgraphs import notation_branched_fingerprint

    parsed = []
    for module in (rowgraphs, subgraphs):
        keep = module.stage
        monkeypatch.setattr(module, "stage", lambda df, purpose, keep=keep: parsed.append((purpose, df.count())) or keep(df, purpose))
    notations = ["CC(O)C", "c1ccccc1", "C", "C1CC"]
    rows = [(i, notations[i % 4]) for i in range(400)] + [(None, "CO"), (7, "CN"), (0, "CC(O)C"), (401, None)]
    df = spark.createDataFrame(rows, "k int, s string")
    monkeypatch.setattr(graph.alike, "__defaults__", (500,))
    keys, names, errors = notation_branched_keys(df, "k", "s", 1, 3)
    bits, _ = notation_branched_fingerprint(df, "k", "s", 1, 3)
    paths, _ = notation_paths(df, "k", "s", 1, 3)
    assert max(n for purpose, n in parsed if purpose in ("subgraphs", "rowgraphs")) == 7
    assert sorted((r.name, r.notation) for r in errors.collect() if r.name != 401) == sorted(x for x in rows if x[1] == "C1CC")
    assert [r.error for r in errors.where("name = 401").collect()] == ["empty notation"]
    assert names.count() == 303 and names.where("graph_id is null").count() == 1
    got = {(r.graph_id, r.code): r.n for r in keys.collect()}
    assert len(got) == keys.count()
    alone = {s: {r.code: r.n for r in branched_keys(*notation_to_graph(spark.createDataFrame([(1, s)], "k int, s string"), "k", "s")[:2], 1, 3).collect()}
             for s in ("CC(O)C", "c1ccccc1", "CN", "CO")}
    expected = {}
    for k, s in rows:
        for code, n in alone.get(s, {}).items():
            expected[k, code] = expected.get((k, code), 0) + n
    assert got == expected
    for table in (bits, paths):
        found = {r.graph_id: r.features for r in table.collect()}
        assert len(found) == table.count() == 302 and sum(found[2]) == 0 and found[4] == found[8] == found[0] != found[1]
        assert found[None] != found[0]


def test_groups_of_a_common_notation_are_bounded(spark):
    from featureloom.operators.graph import alike

    groups, repeated = alike(spark.range(3000).selectExpr("id", "'CCO' AS s"), "id", "s", size=100)
    sizes = [r.n for r in groups.selectExpr("size(ids) AS n").collect()]
    assert not repeated and sum(sizes) == 3000 and max(sizes) < 200


def test_environments_of_equal_notations_are_found_once(spark, monkeypatch):
    """Groups of rows of one notation give the rows that every graph of its own gives, and there are far fewer of them."""
    from featureloom.operators import subgraphs as SG
    from featureloom.operators.graph import notation_to_graph

    kinds = ["CC(O)Cc1ccccc1", "C", "C1CC", "CCO", "OCC", "C.C=C"]
    df = spark.createDataFrame([(f"k{i}", kinds[i % len(kinds)]) for i in range(120)], "k string, s string")
    nodes, edges, bad = notation_to_graph(df, "k", "s")
    seen, whole = [], SG.circular_environments
    monkeypatch.setattr(SG, "circular_environments", lambda n, e, *a, **b: seen.append(n.select("graph_id").distinct().count()) or whole(n, e, *a, **b))
    for typed in (False, True):
        found, errors = SG.notation_circular_environments(df, "k", "s", 2, typed)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole(nodes, edges, 2, typed=typed).collect()))
        assert sorted(map(tuple, errors.collect())) == sorted(map(tuple, bad.collect())) and errors.count() == 20
    assert seen == [5, 5]
    twice, _ = SG.notation_circular_environments(df.limit(1).union(df.limit(1)), "k", "s", 1)
    once, _ = SG.notation_circular_environments(df.limit(1), "k", "s", 1)
    assert {(r.radius, r.sig): r.n for r in twice.collect()} == {(r.radius, r.sig): 2 * r.n for r in once.collect()}
