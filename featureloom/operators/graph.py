"""Graph tables: construction from line notation, expansion, selection, signatures.

Two tables describe all graphs at once: ``nodes(graph_id, node_id, label, …)`` and
``edges(graph_id, src, dst, kind)`` with both directions of every edge. All joins are on
``(graph_id, node)``, not on the graph alone, so one very large graph spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notation as N
from ..functions.hashing import hex_number
from ..session import dealt, stage


# Room for the ids of the hydrogens of one node.
HYDROGENS = 1 << 20
# Stands for a null label, which is no element and no empty text.
NO_LABEL = "\\N"


# Rows of one notation that share one growing of paths or sets, on average at most.
GROUP = 4096


def alike(df: DataFrame, key: str, col: str, size: int = GROUP, *, unique: bool = False) -> tuple[DataFrame, bool]:
    """``(group, notation, ids)``, and whether a key has several rows: rows of equal notations in groups.

    What follows from the notation alone is found once for each group and handed to its rows by :func:`members`. A notation
    of very many rows has several groups, so no list of ids grows with the table. ``unique`` tells that ``df`` is a staged table
    in which no key has several rows.
    """
    rows = df.select(F.col(key).alias("graph_id"), F.col(col).alias("notation"))
    rows = rows if unique else stage(rows, "notations")
    part = F.pmod(F.xxhash64("graph_id"), F.lit(1 + rows.count() // size))
    groups = rows.groupBy("notation", part.alias("__part")).agg(F.collect_list(F.struct("graph_id")).alias("ids"))
    groups = stage(groups.select(F.monotonically_increasing_id().alias("group"), "notation", "ids"), "alike")
    if unique:
        return groups, False
    repeated = rows.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups, not repeated.isEmpty()


def members(found: DataFrame, groups: DataFrame) -> DataFrame:
    """``found`` of :func:`alike` groups (their number is ``graph_id``) as rows of the keys in them."""
    ids = groups.select(F.col("group").alias("graph_id"), "ids")
    rest = [c for c in found.columns if c != "graph_id"]
    return found.join(dealt(ids), "graph_id").select(F.inline("ids"), *rest)


def notation_kinds(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(graph_id, notation)``, the distinct notations of :func:`alike` groups, and ``(graph_id, group)``, the groups of each."""
    kinds = stage(groups.select("notation").distinct().select(F.monotonically_increasing_id().alias("graph_id"), "notation"), "kinds")
    same = F.col("g.notation").eqNullSafe(F.col("k.notation"))
    homes = groups.select("group", "notation").alias("g").join(dealt(kinds).alias("k"), same).select("graph_id", "group")
    return kinds, stage(homes, "homes")


def kind_members(found: DataFrame, homes: DataFrame, groups: DataFrame) -> DataFrame:
    """``found`` of :func:`notation_kinds` as rows of the keys in their groups; lists of ids are dealt by group, never by notation."""
    rest = [c for c in found.columns if c != "graph_id"]
    return members(found.join(dealt(homes), "graph_id").select(F.col("group").alias("graph_id"), *rest), groups)


def notation_to_graph(
    df: DataFrame, key: str, col: str, staged: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(nodes, edges, errors)`` of the notations in ``col``.

    Parsing is a narrow projection. The parsed rows feed three tables, so they are written
    once to the scratch area by default instead of being parsed three times.
    """
    rows = df.select(F.col(key).alias("graph_id"), F.col(col).alias("notation"))
    parsed = N.with_graph(rows, "notation")
    if staged:
        parsed = stage(parsed, "graphs")
    nodes, edges = graph_tables(parsed)
    errors = parsed.filter("error IS NOT NULL").select(
        F.col("graph_id").alias("name"), "notation", "error"
    )
    return nodes, edges, errors


def graph_tables(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, edges)`` of parsed rows ``(graph_id, atoms, bonds, …)``."""
    # The outer form keeps the optimizer from testing the arrays before it builds them.
    atoms = parsed.select("graph_id", F.posexplode_outer("atoms").alias("pos", "token"))
    fields = N.atom_fields("token")
    nodes = atoms.filter("pos IS NOT NULL").select(
        "graph_id",
        F.col("pos").cast("bigint").alias("node_id"),
        *[c.alias(name) for name, c in fields.items()],
    )
    part = F.split("bond", ",")
    ends = [F.get(part, F.lit(i)).cast("bigint") for i in (0, 1)]
    one_way = (
        parsed.select("graph_id", F.explode_outer("bonds").alias("bond"))
        .filter("bond IS NOT NULL")
        .select("graph_id", ends[0].alias("a"), ends[1].alias("b"),
                F.get(part, F.lit(2)).alias("kind"))
    )
    return nodes, both_directions(one_way)


def both_directions(one_way: DataFrame) -> DataFrame:
    """``(graph_id, src, dst, kind)`` in both directions from ``(graph_id, a, b, kind)``."""
    turn = F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst")),
    )
    return one_way.select("graph_id", "kind", F.inline(turn)).select(
        "graph_id", "src", "dst", "kind"
    )


def with_bond_order(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with ``order_sum``, the sum of the bond orders at the node (0 if isolated)."""
    sums = edges.groupBy("graph_id", F.col("src").alias("node_id")).agg(
        F.sum(N.bond_order("kind")).alias("order_sum")
    )
    return nodes.join(dealt(sums), ["graph_id", "node_id"], "left").withColumn(
        "order_sum", F.coalesce("order_sum", F.lit(0.0))
    )


def implicit_count() -> Column:
    """Hydrogens a node carries beyond its bonds, by the usual valences.

    Reads the columns ``label``, ``aromatic`` and ``order_sum``. An aromatic atom fills its
    lowest valence only.
    """
    order = F.col("order_sum")
    count = F.lit(0)
    for symbol, valences in N.VALENCES.items():
        free = F.lit(0.0)
        for v in reversed(valences):
            free = F.when(order <= v, v - order).otherwise(free)
        lowest = F.greatest(F.lit(float(valences[0])) - order, F.lit(0.0))
        filled = F.floor(F.when(F.col("aromatic"), lowest).otherwise(free)).cast("int")
        count = F.when(F.col("label") == symbol, filled).otherwise(count)
    return count


def expand_implicit(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges with every hydrogen as a node of its own.

    Hydrogen ``k`` of node ``p`` gets the id ``-(HYDROGENS * p + k + 1)``, so ids need no counting
    over the graph. More hydrogens than that at one node are refused.
    """
    n = with_bond_order(nodes, edges)
    count = F.coalesce(F.col("explicit_h"), implicit_count())
    refuse = F.raise_error(F.lit(f"{HYDROGENS} or more hydrogens at one node")).cast("int")
    count = F.when(count >= HYDROGENS, refuse).otherwise(count)
    added = n.filter(count > 0).select(
        "graph_id", F.col("node_id").alias("parent"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("k"),
    )
    hydrogens = added.select(
        "graph_id", "parent", (-(F.col("parent") * HYDROGENS + F.col("k") + 1)).alias("node_id")
    )
    more_nodes = hydrogens.select(
        "graph_id", "node_id", F.lit("H").alias("label"), F.lit(0).alias("charge"),
        F.lit(0).alias("explicit_h"), F.lit(False).alias("aromatic"),
    )
    more_edges = both_directions(hydrogens.select(
        "graph_id", F.col("parent").alias("a"), F.col("node_id").alias("b"),
        F.lit("-").alias("kind"),
    ))
    base = nodes.select("graph_id", "node_id", "label", "charge", "explicit_h", "aromatic")
    return base.unionByName(more_nodes), edges.unionByName(more_edges)


def select_nodes(nodes: DataFrame, atomic_number: int) -> DataFrame:
    """Nodes of one element, e.g. 1 for hydrogen or 6 for carbon."""
    if not 1 <= atomic_number <= len(N.ELEMENTS):
        raise ValueError(f"no element has the atomic number {atomic_number}")
    return nodes.filter(F.col("label") == N.ELEMENTS[atomic_number - 1])


def _halves(text: Column) -> tuple[Column, Column]:
    digest = F.md5(text.cast("binary"))
    return hex_number(digest, 1, 15), hex_number(digest, 16, 15)


def label_signature(label: str) -> Column:
    """``sig_0`` of every node with this label."""
    return F.substring(F.md5(F.lit(label).cast("binary")), 1, 30)


def circular_signatures(
    nodes: DataFrame, edges: DataFrame, radius: int = 2, label: str = "label",
    typed: bool = False,
) -> DataFrame:
    """``(graph_id, node_id, sig_0 … sig_radius)``: hashes of the layers around a node.

    ``sig_0`` hashes the label; a null label is one of its own. Links to ids that are no nodes
    are left out. ``sig_{r+1}`` hashes ``sig_r`` of the node together with the
    number of its neighbours and the sums of their hashes, a form that does not depend on
    the order of the neighbours and adds up partially before the shuffle: a hub node with
    any number of edges is never gathered. With ``typed`` the kind of the edge is hashed
    into what the neighbour contributes.

    A signature is the first 30 hex digits of an md5, held as two 60-bit numbers.
    Each round joins once and aggregates once; the exchange of the links is the same in
    every round and is reused.
    """
    ids = ["graph_id", "node_id"]
    a, b = _halves(F.coalesce(F.col(label).cast("string"), F.lit(NO_LABEL)))
    state = nodes.select(*ids, a.alias("a0"), b.alias("b0"))
    kind = F.col("kind") if typed else F.lit("")
    links = edges.select(
        "graph_id", F.col("src").alias("node_id"), "dst", kind.alias("kind"),
        F.lit(False).alias("own"),
    ).unionByName(nodes.select(
        *ids, F.col("node_id").alias("dst"), F.lit("").alias("kind"), F.lit(True).alias("own")
    ))
    own = F.col("own")
    for r in range(radius):
        cur = (F.col(f"a{r}"), F.col(f"b{r}"))
        sent = _halves(F.concat_ws(":", "kind", *[c.cast("string") for c in cur])) if typed else cur
        carried = [f"{x}{i}" for i in range(r + 1) for x in "ab"]
        # A node hears itself over its own link, so its earlier hashes need no second join.
        # Null-safe, so that the state is exchanged too: adaptive execution splits the links of
        # a hub only if both sides come straight from an exchange.
        same = (F.col("l.graph_id") == F.col("s.graph_id")) & F.col("l.node_id").eqNullSafe(
            F.col("s.node_id")
        )
        heard = links.alias("l").join(dealt(state).alias("s"), same).select(
            "l.graph_id", "dst", "own", *[F.when(own, F.col(c)).alias(c) for c in carried],
            *[F.when(~own, s).cast("decimal(20,0)").alias(f"__{x}") for s, x in zip(sent, "ab")],
        )
        grouped = heard.groupBy("graph_id", F.col("dst").alias("node_id")).agg(
            *[F.max(c).alias(c) for c in carried],
            F.count_if(~own).alias("__n"),
            *[F.coalesce(F.sum(f"__{x}"), F.lit(0)).alias(f"__{x}") for x in "ab"],
        )
        parts = [f"a{r}", f"b{r}", "__n", "__a", "__b"]
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in parts])
        a, b = _halves(text)
        state = grouped.select(
            *ids, *carried, a.alias(f"a{r + 1}"), b.alias(f"b{r + 1}")
        ).filter(F.col("a0").isNotNull())
    half = lambda c: F.lower(F.lpad(F.hex(F.col(c)), 15, "0"))
    return state.select(
        *ids, *[F.concat(half(f"a{i}"), half(f"b{i}")).alias(f"sig_{i}") for i in range(radius + 1)]
    )
