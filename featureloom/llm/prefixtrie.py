"""Trie of conversation prefixes, rolled up by centroid decomposition of its parent-edge forest.

A node is a distinct sequence of first turns. It is known by a sum of 128-bit hashes of (place, role, text), so
prefixes come from running sums and no text is shuffled, and later by its least member and its depth.

Rollup: of a component (a connected part of the tree, its top known) the centroid is the deepest node whose
subtree weighs more than half. The weight of a node is its number of members, for which the subtree sums are
known when nodes are made: a member of length n passes n - d + 1 nodes from depth d on. The nodes of more than half
the weight are just the path from the centroid to the top. What hangs below the centroid falls
apart into the subtrees of its children, whose totals are added along that path, and the rest keeps the
top. A component loses half its weight in a round, so rounds are as many as the logarithm of the weight, however deep
the tree. Components of at most ``bound`` nodes end inside a task, many to a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureloom.llm.shared import partitions, staged

BOUND, HELD = 2_000, 50_000
CHUNK = 1 << 16
_LANES = ("l0", "l1", "l2", "l3")
_LOW = 0xFFFFFFFF
NODE = "m long, depth long"


def _lanes(*cols: str | Column) -> dict[str, Column]:
    """Four 32-bit parts of two hashes; sums of them stay far below the bounds of a long."""
    one, two = F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)
    return {
        "l0": F.shiftrightunsigned(one, 32), "l1": one.bitwiseAND(F.lit(_LOW)),
        "l2": F.shiftrightunsigned(two, 32), "l3": two.bitwiseAND(F.lit(_LOW)),
    }


def _key(high: Column, low: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))


def numbered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(c, i, r, t1, t2, bytes)``: the turns of every conversation from 0 in order, as hashes and byte lengths.

    Rows are dealt to ranges of (conversation, turn) and written, so a range keeps its number ``r``; a
    conversation of any length is spread over ranges, numbered by counts per (conversation, range).
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit("second"), role, text).alias("t2"), F.octet_length(text).cast("long").alias("bytes"),
    )
    order = ["c", F.col("turn").asc_nulls_first(), "t1", "t2"]
    ranged = staged(rows.repartitionByRange(partitions(df), *order).withColumn("r", F.spark_partition_id()), "turns")
    before = _before(ranged.groupBy("c", "r").agg(F.count("*").alias("n")), {"n": "start"})
    inside = F.row_number().over(Window.partitionBy("c", "r").orderBy(*order[1:])) - 1
    return ranged.withColumn("j", inside).join(before, ["c", "r"]).select("c", (F.col("start") + F.col("j")).alias("i"), "r", "t1", "t2", "bytes")


def _before(counts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Per (c, r) the sums of ``columns`` over the earlier ranges of the conversation, under new names."""
    earlier = Window.partitionBy("c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("c", "r", *[F.coalesce(F.sum(old).over(earlier), F.lit(0)).alias(new) for old, new in columns.items()])


def rebuilt_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(c, depth, k1, k2, bytes, len)``, every prefix of at least one turn of every rebuilt conversation, and ``(c, len)`` of all.

    Conversation ``c`` is the first ``crc32(c) % 9`` turns of ``c - c % 5``, all if it has fewer, then its own
    turns behind as many.
    """
    turns = staged(turns, "numbered")
    sizes = turns.groupBy("c").agg(F.count("*").alias("own"))
    convs = sizes.select("c", (F.col("c") - F.col("c") % 5).alias("b"), (F.crc32(F.col("c").cast("string")) % 9).alias("h"), "own")
    convs = convs.join(sizes.select(F.col("c").alias("b"), F.col("own").alias("base")), "b", "left")
    convs = convs.withColumn("s", F.least("h", F.coalesce("base", F.lit(0))))
    convs = convs.select("c", "b", "h", "s", (F.col("s") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    hashed = lambda place: _lanes(place, F.col("t1"), F.col("t2"))
    # At most eight turns of the other conversation.
    first = turns.where("i < 8").select(F.col("c").alias("b"), "i", "bytes", *[v.alias(k) for k, v in hashed(F.col("i")).items()])
    first = first.join(convs, "b").where("i < s")
    running = Window.partitionBy("c").orderBy("i")
    given = first.select("c", (F.col("i") + 1).alias("depth"), "bytes", "len", *[F.sum(x).over(running).alias(x) for x in _LANES])
    heads = convs.join(first.groupBy("c").agg(*[F.sum(x).alias(f"b_{x}") for x in _LANES]), "c", "left").na.fill(0)
    # One row for each range of a conversation: a long one is joined range by range.
    heads = turns.select("c", "r").distinct().join(heads, "c")
    own = turns.join(heads, ["c", "r"]).where("i >= h").withColumn("p", F.col("i") - F.col("h") + F.col("s"))
    own = own.select("c", "r", "p", "bytes", "len", *[f"b_{x}" for x in _LANES], *[v.alias(k) for k, v in hashed(F.col("p")).items()])
    before = _before(own.groupBy("c", "r").agg(*[F.sum(x).alias(x) for x in _LANES]), {x: f"e_{x}" for x in _LANES})
    within = Window.partitionBy("c", "r").orderBy("p")
    own = own.withColumns({x: F.sum(x).over(within) for x in _LANES}).join(before, ["c", "r"])
    own = own.select("c", (F.col("p") + 1).alias("depth"), "bytes", "len", *[(F.col(x) + F.col(f"e_{x}") + F.col(f"b_{x}")).alias(x) for x in _LANES])
    keyed = given.unionByName(own).select("c", "depth", _key(F.col("l0"), F.col("l1")).alias("k1"), _key(F.col("l2"), F.col("l3")).alias("k2"), "bytes", "len")
    return staged(keyed, "prefixes"), staged(convs.select("c", "len"), "lengths")


def make_nodes(prefixes: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and ``(c, depth, m, len)``, the node ``(m, depth)`` of every prefix of every conversation.

    Nodes: ``(m, depth, pm, n, weight, bytes)``; ``pm`` is the least member of the parent (null at the root), ``weight`` the number of
    members summed over the subtree.
    """
    steps = F.sum("len") - F.count("*") * (F.col("depth") - 1)
    found = prefixes.groupBy("depth", "k1", "k2").agg(
        F.min("c").alias("m"), F.count("*").alias("n"), steps.alias("weight"), F.max("bytes").alias("bytes"))
    found = staged(found, "nodes")
    members = staged(prefixes.join(found.select("depth", "k1", "k2", "m"), ["depth", "k1", "k2"]).select("c", "depth", "m", "len"), "members")
    root = lengths.agg(F.min("c").alias("m"), F.count("*").alias("n"), (F.sum("len") + F.count("*")).alias("weight")).where("n > 0")
    top = root.first()
    if top is None:
        return found.select("m", "depth", F.col("m").alias("pm"), "n", "weight", "bytes"), members
    up = members.select(F.col("c").alias("m"), (F.col("depth") + 1).alias("depth"), F.col("m").alias("pm"))
    below = found.where("depth > 1").join(up, ["m", "depth"]).select("m", "depth", "pm", "n", "weight", "bytes")
    first = found.where("depth = 1").select("m", "depth", F.lit(top.m).alias("pm"), "n", "weight", "bytes")
    zero = F.lit(0).cast("long")
    return staged(below.unionByName(first).unionByName(root.select("m", zero.alias("depth"), F.lit(None).cast("long").alias("pm"), "n", "weight", zero.alias("bytes"))), "tree"), members


def _finish(batch: pd.DataFrame) -> pd.DataFrame:
    """All rounds of whole components that are held in one task."""
    batch = batch.sort_values("depth", kind="stable")
    n = len(batch)
    ids = {key: i for i, key in enumerate(zip(batch["m"], batch["depth"]))}
    top = batch["is_top"].to_numpy()
    parent = np.array([-1 if t else ids[p, d - 1] for t, p, d in zip(top.tolist(), batch["pm"].tolist(), batch["depth"].tolist())], np.int64)
    # Places in depth-first order, so that a subtree is a range.
    size, place, after = [1] * n, [0] * n, [0] * n
    up = parent.tolist()
    for i in range(n - 1, -1, -1):
        if up[i] >= 0:
            size[up[i]] += size[i]
    free = 0
    for i in range(n):
        if up[i] < 0:
            place[i], free = free, free + size[i]
        else:
            place[i] = after[up[i]]
            after[up[i]] += size[i]
        after[i] = place[i] + 1
    order = np.argsort(place)
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    parent, size, depth = np.where(parent >= 0, back[parent], -1)[order], np.array(size)[order], batch["depth"].to_numpy()[order]
    weight, values = batch["weight"].to_numpy()[order].copy(), batch[["leaves", "saved"]].to_numpy()[order]
    acc = batch[["acc_leaves", "acc_saved"]].to_numpy()[order].copy()
    comp = np.zeros(n, np.int64)  # the place of the top
    tops = np.flatnonzero(parent < 0)
    comp[:] = tops[np.searchsorted(tops, np.arange(n), side="right") - 1]
    live = np.arange(n)
    while len(live):
        c = comp[live]
        heavy = live[2 * weight[live] > weight[c]]
        # the last heavy node of a component in depth-first order is the deepest one: they form a path
        centroid = np.full(n, -1, np.int64)
        centroid[comp[heavy]] = heavy
        mid = centroid[c]
        inside = (live >= mid) & (live < mid + size[mid])
        sums = np.zeros((n, 2), np.int64)
        np.add.at(sums, c[inside], values[live[inside]])
        acc[heavy] += sums[comp[heavy]]
        rest = heavy[heavy != centroid[comp[heavy]]]
        weight[rest] -= weight[centroid[comp[rest]]]
        # below the centroid every node goes to the subtree of the last child of it that comes before
        below = live[inside & (live != mid)]
        kids = below[parent[below] == centroid[comp[below]]]
        keys = comp[kids] * n + kids
        by = np.argsort(keys)
        label = kids[by][np.searchsorted(keys[by], comp[below] * n + below, side="right") - 1] if len(below) else below
        comp[below] = label
        live = live[live != mid]
    out = batch.iloc[order][["m", "depth"]].reset_index(drop=True)
    out["n_leaves"], out["saved_tokens"] = acc[:, 0], acc[:, 1]
    return out


def _finish_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by component; several whole components at a time."""
    held: list[pd.DataFrame] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < HELD:
            continue
        all_ = pd.concat(held, ignore_index=True)
        last = (all_["cm"] == all_["cm"].iloc[-1]) & (all_["cd"] == all_["cd"].iloc[-1])
        if not last.all():
            yield _finish(all_[~last])
        held, rows = [all_[last]], int(last.sum())
    if rows:
        yield _finish(pd.concat(held, ignore_index=True))


def roll_up(nodes: DataFrame, members: DataFrame, bound: int = BOUND) -> DataFrame:
    """``(m, depth, n_leaves, saved_tokens)``: sums of ``leaves`` and ``saved`` of ``nodes`` over every subtree.

    ``nodes`` has ``m, depth, pm, weight, leaves, saved``; the component ``(cm, cd)`` of a node is its top. Every round
    is written. A row of a component of more than ``bound`` nodes asks ``members`` which child of the centroid
    its least member passes.
    """
    root = F.col("pm").isNull()
    zero = F.lit(0).cast("long")
    tops = nodes.where(root).select("m", "depth").first()
    if tops is None:
        return nodes.select("m", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    live = nodes.select("m", "depth", F.coalesce("pm", "m").alias("pm"), "weight", "leaves", "saved", F.lit(tops.m).alias("cm"), F.lit(tops.depth).alias("cd"),
                        zero.alias("acc_leaves"), zero.alias("acc_saved"), root.alias("is_top"))
    small, done = [], []
    while True:
        sizes = live.groupBy("cm", "cd").agg(F.count("*").alias("size"), F.max("weight").alias("all"))
        live = live.join(sizes, ["cm", "cd"])
        small.append(live.where(F.col("size") <= bound).drop("size", "all"))
        large = live.where(F.col("size") > bound)
        heavy = F.col("weight") * 2 > F.col("all")
        mids = staged(large.where(heavy).groupBy("cm", "cd").agg(F.max_by(F.struct("m", "depth", "weight"), "depth").alias("mid")).select(
            "cm", "cd", F.col("mid.m").alias("xm"), F.col("mid.depth").alias("xd"), F.col("mid.weight").alias("xw")), "centroids")
        if mids.isEmpty():
            break
        # The members of the centroids' children: whose prefix at the depth below is a node with the centroid as parent.
        kids = nodes.join(mids.select("cm", "cd", F.col("xm").alias("pm"), (F.col("xd") + 1).alias("depth")), ["pm", "depth"]).select("m", "depth", "cm", "cd")
        paths = members.select("c", "depth", "m").join(kids, ["m", "depth"]).select(F.col("c").alias("m"), F.col("m").alias("km"), F.col("depth").alias("kd"), "cm", "cd")
        large = large.join(mids, ["cm", "cd"]).join(paths, ["cm", "cd", "m"], "left").withColumn("path", heavy)
        below = F.col("km").isNotNull() & (F.col("depth") >= F.col("kd"))
        mid = (F.col("m") == F.col("xm")) & (F.col("depth") == F.col("xd"))
        large = staged(large.withColumns({"below": below, "mid": mid}).drop("size", "all"), "split")
        sums = large.where("below or mid").groupBy("cm", "cd").agg(F.sum("leaves").alias("s_leaves"), F.sum("saved").alias("s_saved"))
        large = large.join(sums, ["cm", "cd"])
        add = lambda x: F.col(f"acc_{x}") + F.when(F.col("path"), F.col(f"s_{x}")).otherwise(0)
        large = large.withColumns({
            "acc_leaves": add("leaves"), "acc_saved": add("saved"),
            "weight": F.when(F.col("path") & ~F.col("mid"), F.col("weight") - F.col("xw")).otherwise(F.col("weight")),
            "is_top": F.when(F.col("below"), (F.col("m") == F.col("km")) & (F.col("depth") == F.col("kd"))).otherwise(F.col("is_top")),
            "cm": F.when(F.col("below"), F.col("km")).otherwise(F.col("cm")), "cd": F.when(F.col("below"), F.col("kd")).otherwise(F.col("cd")),
        })
        large = staged(large.select("m", "depth", "pm", "weight", "leaves", "saved", "cm", "cd", "acc_leaves", "acc_saved", "is_top", "mid"), "components")
        done.append(large.where("mid").select("m", "depth", F.col("acc_leaves").alias("n_leaves"), F.col("acc_saved").alias("saved_tokens")))
        live = large.where("not mid").drop("mid")
    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    dealt = rest.repartition(partitions(nodes), "cm", "cd").sortWithinPartitions("cm", "cd")
    out = dealt.mapInPandas(_finish_all, f"{NODE}, n_leaves long, saved_tokens long")
    for part in done:
        out = out.unionByName(part)
    return out


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (m, depth, c): pieces of the joined ids of a node, none much longer than :data:`CHUNK`."""
    step = CHUNK // 8
    for batch in batches:
        out: list[tuple[int, int, list]] = []
        for m, depth, c in zip(batch["m"].tolist(), batch["depth"].tolist(), batch["c"].tolist()):
            if out and out[-1][:2] == (m, depth) and len(out[-1][2]) < step:
                out[-1][2].append(c)
            else:
                out.append((m, depth, [c]))
        rows = [(m, depth, ids[0], ",".join(map(str, ids))) for m, depth, ids in out]
        yield pd.DataFrame(rows, columns=["m", "depth", "first", "ids"])


def _hash_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces sorted by (m, depth, first): one digest of each node, piece after piece."""
    node, state = None, None
    for batch in batches:
        out = []
        for m, depth, ids in zip(batch["m"], batch["depth"], batch["ids"]):
            if (m, depth) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (m, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["m", "depth", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=["m", "depth", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``(m, depth, ends_sha256)`` of nodes where conversations ``c`` end: SHA-256 of their ids, ascending, joined by commas.

    Ids are sorted and joined in ranges; a node with very many ends costs its last task one row for each piece.
    """
    ranged = ends.repartitionByRange(partitions(ends), "m", "depth", "c").sortWithinPartitions("m", "depth", "c")
    pieces = ranged.mapInPandas(_chunks, f"{NODE}, first long, ids string")
    return pieces.repartition(partitions(ends), "m", "depth").sortWithinPartitions("m", "depth", "first").mapInPandas(_hash_chunks, f"{NODE}, ends_sha256 string")


def conversation_trie(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", bound: int = BOUND,
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations; columns as ``op11`` states them.

    Turns are ordered with null first; rows of an equal turn by the hashes of role and text, so repeated rows
    are turns of their own and the order of the table does not matter. Null roles and texts are empty. Rows without a
    conversation id take no part. An empty table gives no rows; conversations that are rebuilt without turns are members of the
    root. Other columns are not read.
    """
    prefixes, lengths = rebuilt_prefixes(numbered_turns(df, conv, turn, role, text))
    nodes, members = make_nodes(prefixes, lengths)
    root = nodes.where("depth = 0").select("m").first()
    # Of n nodes all but the root are a child: the number of children comes from the nodes themselves.
    kids = nodes.where("depth > 0").groupBy(F.col("pm").alias("m"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(kids, ["m", "depth"], "left").na.fill(0, ["n_children"]).withColumns({
        "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n") - 1) * F.col("bytes")}), "tree")
    ends = members.where("depth = len").select("m", "depth", "c")
    if root is not None:
        ends = ends.unionByName(lengths.where("len = 0").select(F.lit(root.m).alias("m"), F.lit(0).cast("long").alias("depth"), "c"))
    rolled = roll_up(nodes.select("m", "depth", "pm", "weight", "leaves", "saved"), members, bound)
    out = nodes.join(rolled, ["m", "depth"]).join(end_digests(ends), ["m", "depth"], "left")
    return out.select(
        F.col("m").alias("conv_id"), "depth", F.col("pm").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
