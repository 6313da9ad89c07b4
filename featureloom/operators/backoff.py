"""Reference table over key levels and the back-off lookup in it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEP = "\x1f"


def level_key(cols: list[str]) -> Column:
    """One text for the columns of a level; a null part stays distinct from an empty one."""
    return F.concat_ws(_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])


_STATS = ("min", "mean", "max", "n", "total")


def fit_backoff(
    train: DataFrame, levels: list[list[str]], value: str, conditions: list[str] = (), mergeable: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """``(…conditions, level, key, min, mean, max, n)`` of the known values.

    ``levels`` goes from the coarsest (level 1) to the finest. All levels are counted in one
    pass; the aggregate is partial, so a key shared by many rows costs one row per map task.
    A decimal value gives a mean that does not depend on the order of summation. ``mergeable`` adds ``total``, the
    sum behind the mean, with which :func:`merge_backoff` can take in later rows. ``weight`` is a count of equal rows that stand as one.
    """
    keys = F.array(*[
        F.struct(F.lit(i).alias("level"), level_key(cols).alias("key"))
        for i, cols in enumerate(levels, 1)
    ])
    known = train.filter(F.col(value).isNotNull())
    copies = F.lit(1) if weight is None else F.col(weight)
    rows = known.select(*conditions, F.col(value).alias("__v"), copies.cast("bigint").alias("__w"), F.inline(keys))
    kind = train.schema[value].dataType
    summed = F.sum("__v") if weight is None else F.sum(F.col("__v") * (F.col("__w").cast("decimal(18,0)") if isinstance(kind, T.DecimalType) else F.col("__w")))
    total = summed.cast("double") if isinstance(kind, T.DecimalType) else summed
    return rows.groupBy(*conditions, "level", "key").agg(
        F.min("__v").cast("double").alias("min"),
        (total / F.sum("__w")).alias("mean"),
        F.max("__v").cast("double").alias("max"),
        F.sum("__w").alias("n"),
        *([summed.alias("total")] if mergeable else []),
    )


def merge_backoff(*tables: DataFrame) -> DataFrame:
    """One table of several that were fitted with ``mergeable`` on parts of the rows, by the same levels and conditions.

    Least and greatest values, counts and sums are folded, and the mean is taken from these. With decimal values the result is,
    bit for bit, that of one fit on all rows; sums of doubles may differ in their last digits. The result can be
    merged again.
    """
    if not tables or any("total" not in t.columns for t in tables):
        raise ValueError("tables to be merged must have been fitted with mergeable=True")
    every = reduce(lambda a, b: a.unionByName(b), tables)
    keys = [c for c in every.columns if c not in _STATS]
    kind = every.schema["total"].dataType
    total = F.sum("total").cast(kind) if isinstance(kind, T.DecimalType) else F.sum("total")
    return every.groupBy(*keys).agg(
        F.min("min").alias("min"), (total.cast("double") / F.sum("n")).alias("mean"), F.max("max").alias("max"),
        F.sum("n").alias("n"), total.alias("total"),
    )


def predict_backoff(
    df: DataFrame, table: DataFrame, levels: list[list[str]], min_support: int = 1,
    conditions: dict[str, str] | None = None,
) -> DataFrame:
    """``df`` with ``predicted``, ``lo``, ``hi``, ``support`` and ``level``.

    The finest level that has at least ``min_support`` known values answers; all five are
    null where none has. ``conditions`` picks the part of the table fitted for them; a table
    fitted with conditions must have all of them pinned, or a row would have several answers.

    The answer depends only on the level columns. Their distinct combinations are looked up,
    level by level, and the result is joined back once; a hot combination is looked up once
    and its rows sit on the outer side of a left join, which adaptive execution can split.
    """
    fitted = [c for c in table.columns if c not in ("level", "key", *_STATS)]
    if set(fitted) != set(conditions or {}):
        raise ValueError(f"the table was fitted for the conditions {fitted}, given are {sorted(conditions or {})}")
    usable = table.filter(F.col("n") >= min_support)
    for name, wanted in (conditions or {}).items():
        usable = usable.filter(F.col(name) == F.lit(wanted))
    cols = list(dict.fromkeys(c for level in levels for c in level))
    combos = df.select(*cols).distinct()
    order = range(len(levels), 0, -1)
    for i in order:
        stats = usable.filter(F.col("level") == i).select(
            F.col("key").alias(f"__k{i}"),
            F.struct("mean", "min", "max", "n", "level").alias(f"__s{i}"),
        )
        combos = combos.withColumn(f"__k{i}", level_key(levels[i - 1])).join(
            stats, f"__k{i}", "left"
        )
    best = F.coalesce(*[F.col(f"__s{i}") for i in order])
    answers = combos.select(
        *[F.col(c).alias(f"__q_{c}") for c in cols],
        best["mean"].alias("predicted"), best["min"].alias("lo"), best["max"].alias("hi"),
        best["n"].alias("support"), best["level"].alias("level"),
    )
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__q_{c}")) for c in cols])
    return df.join(answers, same, "left").drop(*[f"__q_{c}" for c in cols])
