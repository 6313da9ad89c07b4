"""Paths of graphs that fit in one row: no join and no shuffle per path length.

A line notation puts a whole graph into one row, and nearly all such graphs are small. Their
paths are grown inside the row. Rows whose paths might be too many for that are found by an
upper bound and go through the joins of :mod:`fingerprints`, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notation as N
from ..session import spread, stage
from .fingerprints import fold_bits, member_words, path_fingerprint
from .graph import alike, graph_tables, members

# Walks a row may have before its graph is handed to the joins. A state takes some hundred
# bytes, so this keeps a row within tens of megabytes.
MAX_WALKS = 50_000


def _adjacency(bonds: Column, labels: Column, typed: bool) -> Column:
    """Array over the atoms: the ``(src, dst, sep, label)`` of every bond at the atom."""

    def both(text):
        parts = F.split(text, ",")
        a, b = (F.get(parts, F.lit(i)).cast("int") for i in (0, 1))
        sep = F.get(parts, F.lit(2)) if typed else F.lit(">")
        return F.array(*[
            F.struct(x.alias("src"), y.alias("dst"), sep.alias("sep"), F.get(labels, y).alias("label"))
            for x, y in ((a, b), (b, a))
        ])

    return F.sort_array(F.flatten(F.transform(bonds, both)))


def _by_atom(links: Column, sources: Column, n: Column) -> Column:
    """Cut the links, sorted by source, into one slice per atom."""

    def of(i):
        first = F.array_position(sources, i).cast("int")
        after = F.size(sources) + 1 - F.array_position(F.reverse(sources), i).cast("int")
        return F.when(first > 0, F.slice(links, first, after - first + 1))

    return F.transform(F.sequence(F.lit(0), n - 1), of)


def _walks(adjacency: Column, max_len: int) -> Column:
    """Number of walks with ``max_len`` steps.

    There are at least as many of them as paths of any length up to that, because a walk can
    always turn back.
    """
    ones = F.transform(adjacency, lambda _: F.lit(1.0))

    def longer(counts, _):
        return F.transform(adjacency, lambda links: F.coalesce(
            F.aggregate(links, F.lit(0.0), lambda s, e: s + F.get(counts, e["dst"])), F.lit(0.0)
        ))

    last = F.aggregate(F.sequence(F.lit(1), F.lit(max_len)), ones, longer)
    return F.aggregate(last, F.lit(0.0), lambda s, x: s + x)


def _paths(labels: Column, adjacency: Column, min_len: int, max_len: int) -> Column:
    """Distinct path texts of a row, each in the smaller of its two directions."""
    front = F.transform(labels, lambda l, i: F.struct(
        i.alias("at"), l.alias("fwd"), l.alias("rev"), F.array(i).alias("seen")
    ))
    texts = lambda states: F.transform(states, lambda s: F.least(s["fwd"], s["rev"]))

    def grow(state):
        free = F.filter(F.get(adjacency, state["at"]), lambda e: ~F.array_contains(state["seen"], e["dst"]))
        longer = F.transform(free, lambda e: F.struct(
            e["dst"].alias("at"),
            F.concat(state["fwd"], e["sep"], e["label"]).alias("fwd"),
            F.concat(e["label"], e["sep"], state["rev"]).alias("rev"),
            F.concat(state["seen"], F.array(e["dst"])).alias("seen"),
        ))
        return F.coalesce(longer, F.slice(F.array(state), 1, 0))

    def round_(acc, length):
        # The texts of a front are taken when the next one is built, so it is built once.
        found = F.when(
            length > min_len, F.array_union(acc["found"], texts(acc["front"]))
        ).otherwise(acc["found"])
        return F.struct(
            F.flatten(F.transform(acc["front"], grow)).alias("front"), found.alias("found")
        )

    start = F.struct(front.alias("front"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(max_len)), start, round_,
        lambda acc: F.array_union(acc["found"], texts(acc["front"])),
    )


def notation_paths(
    df: DataFrame, key: str, col: str, min_len: int = 1, max_len: int = 7, typed: bool = True,
    n_bits: int = 2048, bits_per_path: int = 2, max_walks: int = MAX_WALKS, dense: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(fingerprints, errors)`` of the notations in ``col``.

    The same bits as :func:`path_fingerprint` over the tables of
    :func:`notation_to_graph`, whichever way a row takes. Paths are grown once for each group of rows of one notation.
    """
    groups, repeated = alike(df, key, col)
    rows = spread(groups).select(F.col("group").alias("graph_id"), "notation")
    label = lambda x: N.atom_fields(x)["label"]
    parsed = (
        N.with_graph(rows, "notation")
        .withColumn("labels", F.transform("atoms", label))
        .withColumn("links", _adjacency(F.col("bonds"), F.col("labels"), typed))
        .withColumn("sources", F.transform("links", lambda e: e["src"]))
        .withColumn("adjacency", _by_atom(F.col("links"), F.col("sources"), F.size("labels")))
        .withColumn("walks", _walks(F.col("adjacency"), max_len))
        .drop("links", "sources")
    )
    parsed = stage(parsed, "rowgraphs")
    bad = parsed.filter("error IS NOT NULL").select("graph_id", "notation", "error")
    errors = members(bad, groups).withColumnRenamed("graph_id", "name")
    paths = _paths(F.col("labels"), F.col("adjacency"), min_len, max_len)
    small = parsed.filter(F.col("walks") <= max_walks).select("graph_id", paths.alias("paths"))
    # A graph of single atoms has no path; its row stays, with a zero vector.
    exploded = small.select("graph_id", F.explode_outer("paths").alias("path"))
    found = fold_bits(exploded, "graph_id", "path", n_bits, bits_per_path, dense=False)
    large = parsed.filter(F.col("walks") > max_walks)
    if not large.isEmpty():
        nodes, edges = graph_tables(large)
        joined = path_fingerprint(
            nodes, edges, min_len, max_len, n_bits, bits_per_path, typed=typed, dense=False
        )
        found = found.unionByName(joined)
    return member_words(found, groups, repeated, n_bits, dense), errors
