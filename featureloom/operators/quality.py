"""Keep-first dedup, rule-based routing, error capture and stage summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import notation as N
from ..session import stage


def dedup_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` of every key.

    ``min_by`` aggregates partially before the shuffle, so a key that holds a large share of
    the rows reaches the final task as one row per map task.
    """
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), rank).alias("__row")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    )


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(rows, keys, duplicates)``: how many rows keep-first removes.

    Two partial counts; rows are never gathered by key.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    distinct = F.count(F.lit(1))
    return per_key.agg(
        total.alias("rows"), distinct.alias("keys"), (total - distinct).alias("duplicates")
    )


def screen_notation(df: DataFrame, col: str, staged: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(valid rows, invalid rows with the column error)``."""
    checked = N.with_graph(df, col, "__atoms", "__bonds", "error").drop("__atoms", "__bonds")
    if staged:
        checked = stage(checked, "screen")
    return checked.filter("error IS NULL").drop("error"), checked.filter("error IS NOT NULL")


def flag_rules(df: DataFrame, rules: dict[str, Column], into: str = "reasons") -> DataFrame:
    """Add the list of reasons whose rule holds, in the order the rules are given."""
    hits = [F.when(rule, F.lit(reason)) for reason, rule in rules.items()]
    return df.withColumn(into, F.array_compact(F.array(*hits)))


def route(df: DataFrame, reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """``(rows without a reason, rows with one or more)``."""
    return df.filter(F.size(reasons) == 0), df.filter(F.size(reasons) > 0)


def warnings(df: DataFrame, name: str, reasons: str = "reasons") -> DataFrame:
    """``(name, warning)`` for the routed rows."""
    text = F.concat(F.col(name).cast("string"), F.lit(": rerouted → "), F.concat_ws(", ", reasons))
    return df.filter(F.size(reasons) > 0).select(F.col(name), text.alias("warning"))


# Usual upper valence of elements that are handled separately above it.
EXOTIC_VALENCE_LIMITS = {"S": 4, "P": 4, "As": 4, "Se": 4}
# Atomic numbers of the transition metals that are handled separately.
TRANSITION_METALS = (*range(21, 31), *range(39, 49), 57, *range(72, 80))
# Fixed value: heavy atoms above which a graph counts as very large.
MAX_HEAVY_ATOMS = 150


def graph_metrics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per graph: heavy atoms, hyper-valent atoms, transition metals, radical centres.

    Two levels of partial aggregation: bond orders per node, then flags per graph. A radical
    centre is a neutral bracket atom of C, N or O with unfilled valence.
    """
    from .graph import implicit_count, with_bond_order

    n = with_bond_order(nodes, edges)
    hydrogens = F.coalesce(F.col("explicit_h"), implicit_count())
    total = F.col("order_sum") + hydrogens
    limit = F.lit(None).cast("int")
    for symbol, value in EXOTIC_VALENCE_LIMITS.items():
        limit = F.when(F.col("label") == symbol, F.lit(value)).otherwise(limit)
    open_shell = F.col("explicit_h").isNotNull() & (F.col("charge") == 0) & (
        ((F.col("label") == "C") & (total < 4))
        | ((F.col("label") == "N") & (total < 3))
        | ((F.col("label") == "O") & (total < 2))
    )
    metals = [N.ELEMENTS[z - 1] for z in TRANSITION_METALS]
    return n.groupBy("graph_id").agg(
        F.count_if(F.col("label") != "H").alias("heavy_atoms"),
        F.count_if(total > limit).alias("hypervalent"),
        F.count_if(F.col("label").isin(*metals)).alias("metals"),
        F.count_if(open_shell).alias("radicals"),
    )


def graph_rules(metrics: DataFrame, disconnected: Column | None = None) -> DataFrame:
    """Reasons for every row of :func:`graph_metrics`."""
    rules = {
        "hyper-valent atom": F.col("hypervalent") > 0,
        "transition metal": F.col("metals") > 0,
        "radical": F.col("radicals") > 0,
        "size": F.col("heavy_atoms") > MAX_HEAVY_ATOMS,
    }
    if disconnected is not None:
        rules["disconnected fragments"] = disconnected
    return flag_rules(metrics, rules)


def reject_degenerate(df: DataFrame, point: str, eps: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)`` for rows whose ``point`` column is an array of points.

    A record is rejected when every one of its points is closer than ``eps`` to the origin.
    """
    length = lambda p: F.sqrt(F.aggregate(p, F.lit(0.0), lambda a, x: a + x * x))
    degenerate = F.coalesce(F.forall(point, lambda p: length(p) < eps), F.lit(True))
    return df.filter(~degenerate), df.filter(degenerate)


def degenerate_keys(points: DataFrame, key: str, coords: list[str], eps: float = 0.1) -> DataFrame:
    """Keys of a long table of points that all lie within ``eps`` of the origin."""
    norm = F.sqrt(reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in coords]))
    return points.groupBy(key).agg(F.max(norm).alias("max_norm")).filter(F.col("max_norm") < eps)


def failed_keys(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Rows of ``inputs`` whose key produced no row in ``outputs``.

    The output keys are made distinct first, so repeats on that side cannot skew the join.
    """
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def run_summary(stages: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """``(stage, metric, value)``: one aggregate per stage table."""
    parts = []
    for name, (df, metrics) in stages.items():
        rows = F.array(*[
            F.struct(F.lit(m).alias("metric"), agg.cast("bigint").alias("value"))
            for m, agg in metrics.items()
        ])
        parts.append(df.agg(rows.alias("r")).select(F.lit(name).alias("stage"), F.inline("r")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def observed(df: DataFrame, purpose: str, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df``, written once and read back, and the ``metrics`` that were counted while its rows went by.

    The counts come from the plan that writes the rows: no stage is run again to be counted.
    """
    seen = Observation(purpose)
    return stage(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), purpose), seen


def observed_summary(spark: SparkSession, values: dict[str, dict[str, int | None]]) -> DataFrame:
    """``(stage, metric, value)`` from numbers that are known already, in the form of :func:`run_summary`."""
    rows = [(name, metric, 0 if n is None else int(n)) for name, found in values.items() for metric, n in found.items()]
    return spark.createDataFrame(rows, "stage string, metric string, value bigint")
