"""Branched fingerprints: every connected set of bonds, and environments told apart by their bonds.

A graph of a line notation fits in one row. Its sets of bonds are grown there by a chain of
generators without a shuffle: each set is reached once, so nothing has to be made distinct, and
sets stream through the task, so their number needs no memory. Graphs in node and edge tables, and rows
with very many bonds or walks, grow their sets by joins with the links of every node instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notation as N
from ..functions.hashing import hex_number
from ..session import dealt, spread, stage
from .fingerprints import fold_bits, member_words
from .graph import alike, circular_signatures, graph_tables, members, notation_to_graph

# Rows with more bonds, or more walks over them, are handed to the joins.
MAX_BONDS = 200
MAX_WALKS = 2_000_000


def subgraph_code(bonds: Column) -> Column:
    """Text of a set of bonds ``(a, b, kind, la, lb)`` that does not depend on the order or the ids of its nodes.

    A node is written with the kinds and labels it is linked to within the set, a bond with its
    two nodes, the smaller first; the texts of all bonds are sorted. Sets of one shape always agree; sets of
    different shapes may, if they differ only in how nodes that look alike are linked further away.
    """

    pair = lambda n, label: F.struct(n.alias("n"), label.alias("label"))
    nodes = F.array_distinct(F.flatten(F.transform(bonds, lambda e: F.array(pair(e["a"], e["la"]), pair(e["b"], e["lb"])))))

    def node(me):
        seen = F.transform(bonds, lambda e: F.when(e["a"] == me["n"], F.concat(e["kind"], e["lb"])).when(e["b"] == me["n"], F.concat(e["kind"], e["la"])))
        return F.struct(me["n"].alias("n"), F.concat(me["label"], F.lit("("), F.array_join(F.sort_array(seen), ","), F.lit(")")).alias("text"))

    def whole(texts):
        of = lambda n: F.get(texts["text"], (F.array_position(texts["n"], n) - 1).cast("int"))
        bond = lambda e: F.call_function("array_join", F.sort_array(F.array(of(e["a"]), of(e["b"]))), e["kind"])
        return F.array_join(F.sort_array(F.transform(bonds, bond)), ";")

    # The texts of the nodes are used twice for each bond; as the only element of an array they are made once.
    return F.get(F.transform(F.array(F.transform(nodes, node)), whole), F.lit(0))


def _lengths(min_len: int, max_len: int) -> None:
    if not 1 <= min_len <= max_len:
        raise ValueError("a set has at least one bond: 1 <= min_len <= max_len")


def _counted(sets: DataFrame) -> DataFrame:
    """``(graph_id, code, n)`` from one row ``(graph_id, bonds)`` a set."""
    return sets.select("graph_id", subgraph_code(F.col("bonds")).alias("code")).groupBy("graph_id", "code").agg(
        F.count(F.lit(1)).alias("n")
    )


def branched_keys(
    nodes: DataFrame, edges: DataFrame, min_len: int = 1, max_len: int = 7, label: str = "label", typed: bool = True,
) -> DataFrame:
    """``(graph_id, code, n)``: codes of the connected sets of ``min_len..max_len`` bonds and how many sets have them.

    Each round joins the nodes of a set with the links there and makes the longer sets distinct. All joins are on
    (graph, node). A null label reads as an empty one; links to ids that are no nodes and loops are
    left out, repeated links count once. A node with ``d`` links is in about ``d ** max_len`` sets, and all
    of them are grown: lower ``max_len`` for graphs with hubs.
    """
    _lengths(min_len, max_len)
    return _counted(_table_sets(nodes, edges, min_len, max_len, label, typed))


def _table_sets(nodes: DataFrame, edges: DataFrame, min_len: int, max_len: int, label: str, typed: bool) -> DataFrame:
    text = F.coalesce(F.col(label).cast("string"), F.lit(""))
    at = nodes.select("graph_id", "node_id", text.alias("text"))
    end = lambda node, name: dealt(at.select("graph_id", F.col("node_id").alias(node), F.col("text").alias(name)))
    kind = F.coalesce(F.col("kind"), F.lit("")) if typed else F.lit(">")
    bonds = (
        edges.filter("src <> dst").select("graph_id", F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), kind.alias("kind"))
        .distinct().join(end("a", "la"), ["graph_id", "a"]).join(end("b", "lb"), ["graph_id", "b"])
        .select("graph_id", F.struct("a", "b", "kind", "la", "lb").alias("bond"))
    )
    bonds = stage(bonds, "bonds")
    ends = F.explode(F.array("bond.a", "bond.b"))
    links = bonds.select("graph_id", ends.alias("node_id"), "bond")
    sets = bonds.select("graph_id", F.array("bond").alias("bonds"))
    found = []
    for length in range(1, max_len + 1):
        if length > 1:
            members = F.array_distinct(F.flatten(F.transform("bonds", lambda e: F.array(e["a"], e["b"]))))
            sets = (
                sets.select("graph_id", "bonds", F.explode(members).alias("node_id"))
                .join(dealt(links), ["graph_id", "node_id"]).filter(~F.array_contains("bonds", F.col("bond")))
                .select("graph_id", F.array_sort(F.array_append("bonds", F.col("bond"))).alias("bonds")).distinct()
            )
            if length < max_len:
                sets = stage(sets, f"sets-{length}")  # read as results and as what the next round grows
        if length >= min_len:
            found.append(sets)
    return reduce(DataFrame.unionByName, found)


def _row_bonds(typed: bool) -> Column:
    """Bonds of a parsed row with the labels of both ends; reads ``bonds`` and ``labels``."""

    def read(text):
        part = F.split(text, ",")
        a, b = (F.get(part, F.lit(i)).cast("int") for i in (0, 1))
        kind = F.get(part, F.lit(2)) if typed else F.lit(">")
        label = lambda i: F.get(F.col("labels"), i)
        return F.struct(a.alias("a"), b.alias("b"), kind.alias("kind"), label(a).alias("la"), label(b).alias("lb"))

    return F.transform("bonds", read)


def _touching() -> Column:
    """For every bond the places of the bonds that share a node with it; reads ``bonds``."""
    shared = lambda x, y: (x["a"] == y["a"]) | (x["a"] == y["b"]) | (x["b"] == y["a"]) | (x["b"] == y["b"])
    places = F.sequence(F.lit(0), F.size("bonds") - 1)
    near = F.transform("bonds", lambda x, i: F.filter(places, lambda j: (i != j) & shared(x, F.get(F.col("bonds"), j))))
    return F.when(F.size("bonds") > 0, near).otherwise(F.array().cast("array<array<int>>"))


def _row_sets(rows: DataFrame, min_len: int, max_len: int) -> DataFrame:
    """``(graph_id, bonds)`` of every set, from rows ``(graph_id, bonds, near)``; narrow, each set once.

    A set starts at its first bond and takes one bond of its list ``ext`` at a time. Those before the one taken are
    never taken later on this branch, and only bonds that no member touched before are added to the list.
    """
    none = F.array().cast("array<int>")

    def state(taken, ext, seen, grows):
        return F.struct(taken.alias("taken"), ext.alias("ext"), seen.alias("seen"), F.lit(grows).alias("grows"))

    near = lambda i: F.get(F.col("near"), i)
    root, seen, ext = F.get(F.col("s.taken"), F.lit(0)), F.col("s.seen"), F.col("s.ext")

    def longer(w, i):
        fresh = F.filter(near(w), lambda u: (u > root) & ~F.array_contains(seen, u))
        return state(F.array_append("s.taken", w), F.concat(F.slice(ext, i + 2, F.size(ext)), fresh), F.array_union(seen, near(w)), True)

    def longest(w):
        return state(F.array_append("s.taken", w), none, none, False)

    first = F.explode(F.transform(F.sequence(F.lit(0), F.size("bonds") - 1), lambda r: state(
        F.array(r), F.filter(near(r), lambda u: u > r), F.concat(F.array(r), near(r)), max_len > 1
    )))
    done = F.array(state(F.col("s.taken"), none, none, False))
    out = rows.filter(F.size("bonds") > 0).select("graph_id", "bonds", "near", first.alias("s"))
    for length in range(2, max_len + 1):
        more = F.transform(ext, longer if length < max_len else longest)
        grown = F.when(F.col("s.grows"), F.concat(done, more)).otherwise(done)
        out = out.select("graph_id", "bonds", "near", F.explode(grown).alias("s"))
    chosen = F.transform("s.taken", lambda i: F.get(F.col("bonds"), i))
    return out.filter(F.size("s.taken") >= min_len).select("graph_id", chosen.alias("bonds"))


def _walks(near: Column, steps: int) -> Column:
    """Number of walks of ``steps`` steps from bond to bond: how much work a row may be."""
    ones = F.transform(near, lambda _: F.lit(1.0))
    more = lambda n, _: F.transform(near, lambda at: F.aggregate(at, F.lit(0.0), lambda s, j: s + F.get(n, j)))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), ones, more) if steps else ones
    return F.aggregate(last, F.lit(0.0), lambda s, x: s + x)


def notation_branched_keys(
    df: DataFrame, key: str, col: str, min_len: int = 1, max_len: int = 7, typed: bool = True,
    max_bonds: int = MAX_BONDS, max_walks: int = MAX_WALKS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(keys, names, errors)``: :func:`branched_keys` of the notations in ``col``, ``graph_id`` of all valid ones, and why others are not.

    The two bounds decide between growing in the row and by joins; the keys are the same either way. Sets are grown
    once for each group of rows of one notation.
    """
    groups, repeated = alike(df, key, col)
    keys, valid, errors = _group_keys(groups, min_len, max_len, typed, max_bonds, max_walks)
    keys = members(keys, groups)
    if repeated:
        keys = keys.groupBy("graph_id", "code").agg(F.sum("n").alias("n"))
    return keys, members(valid, groups), errors


def notation_branched_fingerprint(
    df: DataFrame, key: str, col: str, min_len: int = 1, max_len: int = 7, typed: bool = True,
    n_bits: int = 2048, bits_per_code: int = 2, max_bonds: int = MAX_BONDS, max_walks: int = MAX_WALKS, dense: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(fingerprints, errors)``: :func:`branched_fingerprint` of the notations in ``col``; bits are set once for each group of equal ones."""
    groups, repeated = alike(df, key, col)
    keys, valid, errors = _group_keys(groups, min_len, max_len, typed, max_bonds, max_walks)
    words = branched_fingerprint(keys, valid, n_bits, bits_per_code, dense=False)
    return member_words(words, groups, repeated, n_bits, dense), errors


def _group_keys(
    groups: DataFrame, min_len: int, max_len: int, typed: bool, max_bonds: int, max_walks: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(keys, names)`` by the number of a group, and the errors by the keys in it."""
    _lengths(min_len, max_len)
    rows = spread(groups).select(F.col("group").alias("graph_id"), "notation")
    parsed = stage(N.with_graph(rows, "notation"), "subgraphs")
    bad = parsed.filter("error IS NOT NULL").select("graph_id", "notation", "error")
    errors = members(bad, groups).withColumnRenamed("graph_id", "name")
    valid = parsed.filter("error IS NULL")
    labels = F.transform("atoms", lambda x: N.atom_fields(x)["label"])
    short = valid.filter(F.size("bonds") <= max_bonds).withColumn("labels", labels)
    near = stage(
        short.select("graph_id", "atoms", F.col("bonds").alias("texts"), _row_bonds(typed).alias("bonds"))
        .withColumn("near", _touching()).withColumn("walks", _walks(F.col("near"), max_len - 1)), "touching",
    )
    keys = _counted(_row_sets(near.filter(F.col("walks") <= max_walks), min_len, max_len))
    large = valid.filter(F.size("bonds") > max_bonds).select("graph_id", "atoms", "bonds").unionByName(
        near.filter(F.col("walks") > max_walks).select("graph_id", "atoms", F.col("texts").alias("bonds"))
    )
    if not large.isEmpty():
        nodes, edges = graph_tables(large)
        keys = keys.unionByName(branched_keys(nodes, edges, min_len, max_len, typed=typed))
    return keys, valid.select("graph_id"), errors


def branched_fingerprint(
    keys: DataFrame, graphs: DataFrame, n_bits: int = 2048, bits_per_code: int = 2, dense: bool = True,
) -> DataFrame:
    """Bit vector of the codes of each graph; a graph of ``graphs`` without any bond has a zero vector."""
    rows = keys.select("graph_id", "code").unionByName(graphs.select("graph_id", F.lit(None).cast("string").alias("code")))
    return fold_bits(rows, "graph_id", "code", n_bits, bits_per_code, dense)


def circular_environments(
    nodes: DataFrame, edges: DataFrame, radius: int = 2, label: str = "label", typed: bool = False,
) -> DataFrame:
    """``(graph_id, radius, sig, n)``: layered surroundings, those over the same bonds counted once.

    The surroundings of radius ``r`` hold the bonds at nodes less than ``r`` steps away. Of all that hold the same bonds
    of a graph the one with the least radius stays, then the one with the least signature, so the result does not depend on node
    numbers. Radius 0 has no bonds and keeps every node; a node without links has no other. A set of bonds is known by
    its size and two sums of hashes, which add up before the shuffle; no list of bonds is gathered. Pairs of
    a node and a bond within reach are rows, ``d ** radius`` of them around a node with ``d`` links.
    """
    ids = ["graph_id", "node_id"]
    known = dealt(nodes.select("graph_id", F.col("node_id").alias("dst")))
    kind = F.coalesce(F.col("kind"), F.lit("")) if typed else F.lit("")
    links = edges.filter("src <> dst").select("graph_id", F.col("src").alias("at"), "dst", kind.alias("kind")).distinct()
    links = links.join(known, ["graph_id", "dst"], "left_semi").join(known.withColumnRenamed("dst", "at"), ["graph_id", "at"], "left_semi")
    links = stage(links, "links")
    reach = nodes.select(*ids, F.col("node_id").alias("at"), F.lit(0).alias("steps"))
    front = reach
    for step in range(1, radius):
        front = front.join(dealt(links), ["graph_id", "at"]).select(*ids, F.col("dst").alias("at"), F.lit(step).alias("steps")).distinct()
        reach = reach.unionByName(front)
    bond = [F.least("at", "dst").alias("a"), F.greatest("at", "dst").alias("b"), "kind"]
    within = reach.join(dealt(links), ["graph_id", "at"]).groupBy(*ids, *bond).agg((F.min("steps") + 1).alias("first"))
    digest = F.md5(F.concat_ws(",", F.col("a").cast("string"), F.col("b").cast("string"), "kind").cast("binary"))
    halves = [hex_number(digest, 1, 15), hex_number(digest, 16, 15)]
    sums = within.select(*ids, "first", *[h.cast("decimal(20,0)").alias(x) for h, x in zip(halves, "xy")]).groupBy(*ids).agg(*[
        m for r in range(1, radius + 1) for m in (
            F.count_if(F.col("first") <= r).alias(f"m{r}"),
            *[F.sum(F.when(F.col("first") <= r, F.col(x))).alias(f"{x}{r}") for x in "xy"],
        )
    ]) if radius else None
    sigs = circular_signatures(nodes, links.select("graph_id", F.col("at").alias("src"), "dst", "kind"), radius, label, typed)
    if radius:
        sigs = stage(sigs, "signatures")
    kept = sigs.select("graph_id", F.lit(0).alias("radius"), F.col("sig_0").alias("sig"))
    if radius:
        each = F.inline(F.array(*[
            F.struct(F.lit(r).alias("radius"), F.col(f"sig_{r}").alias("sig"), F.struct(*[F.col(f"{c}{r}").alias(c) for c in "mxy"]).alias("set")) for r in range(1, radius + 1)
        ]))
        rows = sigs.join(dealt(sums), ids).select("graph_id", each)
        least = rows.groupBy("graph_id", "set").agg(F.min(F.struct("radius", "sig")).alias("s"))
        kept = kept.unionByName(least.select("graph_id", "s.radius", "s.sig"))
    return kept.groupBy("graph_id", "radius", "sig").agg(F.count(F.lit(1)).alias("n"))


def notation_circular_environments(
    df: DataFrame, key: str, col: str, radius: int = 2, typed: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(environments, errors)``: :func:`circular_environments` of the notations in ``col``, found once for each group of equal ones."""
    groups, repeated = alike(df, key, col)
    rows = spread(groups).select(F.col("group").alias("graph_id"), "notation")
    nodes, edges, bad = notation_to_graph(rows, "graph_id", "notation")
    found = members(circular_environments(nodes, edges, radius, typed=typed), groups)
    if repeated:
        found = found.groupBy("graph_id", "radius", "sig").agg(F.sum("n").alias("n"))
    errors = members(bad.withColumnRenamed("name", "graph_id"), groups).withColumnRenamed("graph_id", "name")
    return found, errors
