"""Hashed fingerprints over graphs and token sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.families import thin_task
from ..functions.hashing import bit_position
from ..functions.runs import run_bits
from ..functions.vectors import words_to_vector
from ..session import dealt, stage
from .graph import circular_signatures, members

# Above this many 64-bit words, one aggregate per word would make the generated code long.
_WIDE_LIMIT = 64


def fold_bits(
    df: DataFrame, key: str, signatures: str | list[str], n_bits: int = 2048,
    bits_per_signature: int = 1, dense: bool = True, into: str = "features",
) -> DataFrame:
    """One bit vector per key: the bits all its signatures set.

    A null signature sets no bit but keeps its key, with a zero vector if there is no other.
    The vector is built as 64-bit words with ``bit_or``. That is a partial, fixed-size
    aggregate, so a key of any size reaches the final task as one short row per map task.
    ``dense=False`` returns the words, which are 16 times smaller than an ``array<int>``.
    """
    names = [signatures] if isinstance(signatures, str) else list(signatures)
    bits = [bit_position(s, n_bits, j) for s in names for j in range(bits_per_signature)]
    bit = bits[0] if len(bits) == 1 else F.explode(F.array(*bits))
    rows = df.select(key, bit.alias("bit"))
    n_words = (n_bits + 63) // 64
    word = F.floor(F.col("bit") / 64).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit") % 64)
    split = rows.select(key, word.alias("word"), mask.alias("mask"))
    zero = F.lit(0).cast("bigint")
    if n_words <= _WIDE_LIMIT:
        words = split.groupBy(key).agg(*[
            F.bit_or(F.when(F.col("word") == w, F.col("mask")).otherwise(zero)).alias(f"__w{w}")
            for w in range(n_words)
        ]).select(key, F.array(*[f"__w{w}" for w in range(n_words)]).alias("words"))
    else:
        from .histogram import densify

        # Word indices take the place of buckets: at most n_words entries per key.
        per_word = split.groupBy(key, F.col("word").alias("bucket")).agg(F.bit_or("mask").alias("n"))
        words = densify(per_word, key, n_words, "words")
    if not dense:
        return words
    return words.select(key, words_to_vector("words", n_bits).alias(into))


def or_words(df: DataFrame, key: str, n_bits: int = 2048) -> DataFrame:
    """``(key, words)`` with one row per key: the bits of all its rows."""
    n_words = (n_bits + 63) // 64
    if n_words <= _WIDE_LIMIT:
        each = [F.bit_or(F.get("words", F.lit(w))).alias(f"__w{w}") for w in range(n_words)]
        return df.groupBy(key).agg(*each).select(key, F.array(*[f"__w{w}" for w in range(n_words)]).alias("words"))
    from .histogram import densify

    rows = df.select(key, F.posexplode("words").alias("bucket", "word"))
    return densify(rows.groupBy(key, "bucket").agg(F.bit_or("word").alias("n")), key, n_words, "words")


def member_words(words: DataFrame, groups: DataFrame, repeated: bool, n_bits: int, dense: bool) -> DataFrame:
    """Fingerprints of the keys in :func:`alike` groups from the ``words`` of the groups."""
    found = members(words, groups)
    if repeated:
        found = or_words(found, "graph_id", n_bits)
    return found.select("graph_id", words_to_vector("words", n_bits).alias("features")) if dense else found


def circular_fingerprint(
    nodes: DataFrame, edges: DataFrame, radius: int = 2, n_bits: int = 2048,
    label: str = "label", typed: bool = False, dense: bool = True,
) -> DataFrame:
    """Fingerprint of the layered surroundings of every node, radius 0 to ``radius``."""
    sigs = circular_signatures(nodes, edges, radius, label, typed)
    names = [f"sig_{i}" for i in range(radius + 1)]
    return fold_bits(sigs, "graph_id", names, n_bits, dense=dense)


def ngrams(tokens, min_n: int, max_n: int, sep: str = " ") -> Column:
    """All runs of ``min_n`` to ``max_n`` tokens as texts."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens

    def runs(n):
        if n == 1:
            return t
        heads = F.slice(t, 1, F.greatest(F.size(t) - n + 1, F.lit(0)))
        return F.transform(
            heads, lambda x, i: F.concat_ws(sep, x, *[F.get(t, i + k) for k in range(1, n)])
        )

    return F.concat(*[runs(n) for n in range(min_n, max_n + 1)])


def ngram_fingerprint(
    df: DataFrame, key: str, tokens: str, min_n: int = 1, max_n: int = 7,
    n_bits: int = 2048, bits_per_signature: int = 1, dense: bool = True,
) -> DataFrame:
    """Fingerprint of the token runs of each key; works on any text or token column.

    The bits are those of :func:`fold_bits` over :func:`ngrams`. Runs overlap, so no row and no text is made for
    each: a task reads them as pieces of the tokens of a row and hands on the words of the row.
    """
    if not 1 <= min_n <= max_n:
        raise ValueError("a run has at least one token: 1 <= min_n <= max_n")
    if not 1 <= bits_per_signature <= 4:
        raise ValueError("an md5 holds four 8-digit groups, so a run sets 1..4 bits")
    bits = F.arrow_udf(run_bits(min_n, max_n, n_bits, bits_per_signature, " "), "array<bigint>")
    rows = df.select(key, bits(F.col(tokens).cast("array<string>")).alias("words"))
    words = or_words(rows, key, n_bits)
    return words if not dense else words.select(key, words_to_vector("words", n_bits).alias("features"))


def _thin(states: DataFrame, room: int) -> DataFrame:
    """Per (graph, end, path text in both directions), keep the paths that stand for all others.

    Both directions are needed: labels may hold the separator, so one does not give the other.

    Runs on the map side first and once more after the shuffle, like a partial aggregate.
    """
    group = ["graph_id", "node_id", "fwd", "rev"]
    rows = states.select(*group, "visited")
    task = thin_task(room, len(group))
    local = rows.sortWithinPartitions(*group).mapInPandas(task, rows.schema)
    return local.repartition(*group).sortWithinPartitions(*group).mapInPandas(task, rows.schema)


def _without_like_leaves(nodes: DataFrame, edges: DataFrame, text: Column, sep: Column) -> DataFrame:
    """``edges`` without those of leaves that no path text needs.

    A leaf has one link, there and back, so it is an end of every simple path it lies on. A path has two ends:
    two leaves of one label at a node stand for all leaves of that label there, however many there are.
    """
    ids = ["graph_id", "node_id"]
    ways = edges.select("graph_id", F.inline(F.array(*[
        F.struct(F.col(a).alias("node_id"), F.col(b).alias("near"), sep.alias("kind"), F.lit(out).alias("out"))
        for a, b, out in (("src", "dst", True), ("dst", "src", False))
    ])))
    of = lambda out, value: F.min(F.when(F.col("out") == out, F.col(value)))
    leaves = ways.groupBy(*ids).agg(
        F.count_if("out").alias("outs"), F.count_if(~F.col("out")).alias("ins"),
        *[of(out, value).alias(f"{value}_{out}") for value in ("near", "kind") for out in (True, False)],
    ).filter("outs = 1 AND ins = 1 AND near_True = near_False")
    leaves = leaves.join(dealt(nodes.select(*ids, text.alias("text"))), ids)
    held = leaves.groupBy("graph_id", "near_True", "kind_True", "kind_False", "text").agg(
        F.min("node_id").alias("one"), F.max("node_id").alias("other")
    ).select("graph_id", F.explode(F.array("one", "other")).alias("node_id"))
    spare = stage(leaves.select(*ids).join(dealt(held), ids, "left_anti").distinct(), "spare")
    for end in ("src", "dst"):
        edges = edges.join(dealt(spare.withColumnRenamed("node_id", end)), ["graph_id", end], "left_anti")
    return stage(edges, "links")


def _path_rows(
    nodes: DataFrame, edges: DataFrame, min_len: int, max_len: int, label: str, typed: bool,
    hub_degree: int,
) -> DataFrame:
    """``(graph_id, path)`` with repeats; see :func:`path_keys`."""
    ids = ["graph_id", "node_id"]
    sep = F.col("kind") if typed else F.lit(">")
    text = F.coalesce(F.col(label).cast("string"), F.lit(""))

    def counted(edges):
        degrees = edges.groupBy("graph_id", F.col("src").alias("dst")).agg(F.count(F.lit(1)).alias("degree"))
        return degrees, (degrees.agg(F.max("degree")).first()[0] or 0) > hub_degree

    degrees, has_hubs = counted(edges)
    if has_hubs:
        edges = _without_like_leaves(nodes, edges, text, sep)
        degrees, has_hubs = counted(edges)
    ends = nodes.select("graph_id", F.col("node_id").alias("dst"), text.alias("__l"))
    if has_hubs:
        hub = (F.col("degree") > hub_degree).alias("hub")
        ends = ends.join(dealt(degrees.select("graph_id", "dst", hub)), ["graph_id", "dst"])
    else:
        ends = ends.withColumn("hub", F.lit(False))
    # One row per directed edge, with what a path gains by taking it.
    steps = edges.select(
        "graph_id", F.col("src").alias("node_id"), "dst", sep.alias("__s")
    ).join(dealt(ends), ["graph_id", "dst"])
    if has_hubs:
        steps = stage(steps, "steps")

    states = nodes.select(
        *ids, text.alias("fwd"), text.alias("rev"), F.array("node_id").alias("visited")
    )
    found = []
    for length in range(max_len + 1):
        if length:
            grown = states.join(dealt(steps), ids).filter(~F.array_contains("visited", F.col("dst")))
            states = grown.select(
                "graph_id", F.col("dst").alias("node_id"),
                F.concat("fwd", "__s", "__l").alias("fwd"),
                F.concat("__l", "__s", "rev").alias("rev"),
                F.concat("visited", F.array("dst")).alias("visited"),
                "hub",
            )
            if has_hubs and length < max_len:
                # Read three times below: as paths of this length, plain ends and hub ends.
                states = stage(states, f"paths-{length}")
        if length >= min_len:
            found.append(states.select("graph_id", F.least("fwd", "rev").alias("path")))
        if length and has_hubs and length < max_len:
            hub = states.filter("hub").drop("hub")
            states = states.filter("NOT hub").drop("hub").unionByName(_thin(hub, max_len - length))
        else:
            states = states.drop("hub")
    return reduce(lambda x, y: x.unionByName(y), found)


def path_keys(
    nodes: DataFrame, edges: DataFrame, min_len: int = 1, max_len: int = 7,
    label: str = "label", typed: bool = False, hub_degree: int = 8,
) -> DataFrame:
    """``(graph_id, path)``: label texts of the simple paths with ``min_len..max_len`` edges.

    The text is the smaller of both reading directions; a null label reads as an empty one. A path state holds the visited
    nodes; each round joins the states with the edges at their end. The rounds share their
    exchanges: what one round shuffles is read by the next one and not computed again.

    In graphs without hubs the number of states is bounded by the degree. At nodes with more
    than ``hub_degree`` edges the number of paths through the node would grow with its
    square; there the states with the same end and text are thinned to a family of bounded
    size that allows exactly the same continuations, so no path text is lost. Before that, leaves of one label at one node
    are cut to two, so the states do not grow with the leaves of a hub. A hub with ``n``
    different labels still has about ``n * n / 2`` different texts, all of which are returned.
    """
    return _path_rows(nodes, edges, min_len, max_len, label, typed, hub_degree).distinct()


def path_fingerprint(
    nodes: DataFrame, edges: DataFrame, min_len: int = 1, max_len: int = 7,
    n_bits: int = 2048, bits_per_path: int = 2, label: str = "label", typed: bool = False,
    hub_degree: int = 8, dense: bool = True,
) -> DataFrame:
    """Fingerprint of the linear paths of each graph.

    Repeated paths set the same bits, so they are not made distinct first. A graph without
    any path has a zero vector.
    """
    rows = _path_rows(nodes, edges, min_len, max_len, label, typed, hub_degree).unionByName(
        nodes.select("graph_id", F.lit(None).cast("string").alias("path"))
    )
    return fold_bits(rows, "graph_id", "path", n_bits, bits_per_path, dense)
