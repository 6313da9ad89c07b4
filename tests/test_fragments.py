"""Connected parts against plain search."""

import random

from featureloom import both_directions, graph_fragments, node_fragments


def plain(nodes, links):
    top = {}
    near = {x: set() for x in nodes}
    for a, b in links:
        if a in near and b in near:
            near[a].add(b)
            near[b].add(a)
    for x in sorted(nodes):
        todo = [] if x in top else [x]
        while todo:
            y = todo.pop()
            if y not in top:
                top[y] = x
                todo += near[y]
    return top


def test_fragments(spark):
    """Random graphs, a long path with shuffled numbers, a star, single nodes, loops, repeated links and links to no node."""
    rng = random.Random(5)
    path = list(range(3000))
    rng.shuffle(path)
    graphs = {
        1: (range(40), [(rng.randrange(40), rng.randrange(40)) for _ in range(25)]),
        2: (range(3000), list(zip(path, path[1:]))),
        3: (range(500), [(499, x) for x in range(499)] * 2),
        4: (range(3), [(0, 0), (1, 9)]),
    }
    nodes = spark.createDataFrame([(g, x) for g, (ns, _) in graphs.items() for x in ns], "graph_id int, node_id int")
    links = [(g, a, b, "-") for g, (_, ls) in graphs.items() for a, b in ls]
    edges = both_directions(spark.createDataFrame(links, "graph_id int, a int, b int, kind string"))
    want = {(g, x): top for g, (ns, ls) in graphs.items() for x, top in plain(ns, ls).items()}
    assert {(r.graph_id, r.node_id): r.fragment for r in node_fragments(nodes, edges).collect()} == want
    counts = {r.graph_id: r.fragments for r in graph_fragments(nodes, edges).collect()}
    assert counts == {g: sum(want[k] == k[1] for k in want if k[0] == g) for g in graphs}
    assert graph_fragments(nodes.limit(0), edges.limit(0)).count() == 0
    assert {r.fragments for r in graph_fragments(nodes.filter("graph_id = 4"), edges.limit(0)).collect()} == {3}
