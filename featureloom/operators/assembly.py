"""Label join, vector stacking, feature-set fusion and column naming."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import named
from ..session import dealt
from .quality import dedup_keep_first

META = ("MOLECULE_NAME", "LABEL")


def as_dataframe(spark: SparkSession, x: DataFrame | str | Path) -> DataFrame:
    """A table given as it is, or as a path to comma text (all columns as strings)."""
    if isinstance(x, DataFrame):
        return x
    return spark.read.option("escape", '"').csv(str(x), header=True)


def stack_vectors(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def ragged_vectors(df: DataFrame, n: int, features: str = "features") -> tuple[DataFrame, DataFrame]:
    """``(vectors of length n, all others)``; null vectors are among the others."""
    fits = F.coalesce(F.size(features) == n, F.lit(False))
    return df.filter(fits), df.filter(~fits)


def pad_vectors(df: DataFrame, n: int, features: str = "features") -> DataFrame:
    """Vectors shorter than ``n`` filled with nulls at the end; longer ones are kept whole."""
    element = df.schema[features].dataType.elementType
    missing = F.greatest(F.lit(n) - F.size(features), F.lit(0))
    fill = F.array_repeat(F.lit(None).cast(element), missing)
    return df.withColumn(features, F.concat(F.col(features), fill))


def order_like_files(df: DataFrame, name: str) -> DataFrame:
    """Rows in the order of the file names ``<name>.csv``; meant for the sink only."""
    return df.orderBy(F.concat(F.col(name).cast("string"), F.lit(".csv")))


def label_column(df: DataFrame, k: int) -> str:
    """Name of the 1-based column ``k``, which must not be the key column."""
    if not 2 <= k <= len(df.columns):
        raise ValueError(f"label column {k} is outside 2..{len(df.columns)}")
    return df.columns[k - 1]


def attach_labels(
    matrix: DataFrame, labels: DataFrame, key: str, label: str, *,
    labels_mode: str = "all", order: list[str] | None = None, keep_unlabelled: bool = False,
    keys: DataFrame | None = None,
) -> DataFrame:
    """``(key, label, …rest of matrix)`` by equality of ``key``; a null key equals a null one.

    Repeated keys on the label side give one row each (``labels_mode="all"``) or only the
    first by ``order`` (``"first"``). Rows without a label are dropped, or kept with a null.

    The main join is an inner one, because adaptive execution may then split a hot key on
    either side; a left join would pin the label side. It splits only sides that come
    straight from an exchange: the null-safe key brings one in above the matrix as well. For
    ``keep_unlabelled`` the keys no label knows are found first, by an anti-join of keys
    alone, and enter the label side with a null. They are taken from ``keys`` if a cheaper
    table of them is at hand.
    """
    if labels_mode not in ("all", "first"):
        raise ValueError(f"labels_mode must be 'all' or 'first', not {labels_mode!r}")
    side = labels
    if labels_mode == "first":
        if not order:
            raise ValueError("labels_mode='first' needs the order columns")
        side = dedup_keep_first(labels.select(key, label, *order), [key], order)
    side = side.select(key, F.col(label).alias("label"))
    if keep_unlabelled:
        known = side.select(key).distinct().alias("k")
        every = (matrix if keys is None else keys).select(key).distinct().alias("e")
        kind = side.schema["label"].dataType
        bare = every.join(dealt(known), F.col(f"e.{key}").eqNullSafe(F.col(f"k.{key}")), "left_anti")
        side = side.unionByName(bare.select(key, F.lit(None).cast(kind).alias("label")))
    else:
        side = side.filter("label IS NOT NULL")
    rest = [c for c in matrix.columns if c != key]
    same = F.col(f"m.{key}").eqNullSafe(F.col(f"s.{key}"))
    return matrix.alias("m").join(dealt(side).alias("s"), same, "inner").select(
        F.col(f"m.{key}").alias(key), "s.label", *[f"m.{c}" for c in rest]
    )


def split_meta(df: DataFrame, meta: list[str] = META, into: str = "features") -> DataFrame:
    """Pack every column outside ``meta`` of a wide table into one array."""
    rest = [c for c in df.columns if c not in meta]
    return df.select(*meta, F.array(*[named(c) for c in rest]).alias(into))


def fuse(
    first: DataFrame, second: DataFrame, on: list[str] = ("name", "label"),
    features: str = "features", unique: bool = False,
) -> DataFrame:
    """Inner join on ``on`` (null equals null); the vectors of both sides are concatenated.

    One column is a key without nulls, and a plain equality lets the join use the
    partitioning by key that both sides usually have. With more columns a key may repeat, and
    the null-safe equality spreads its rows by all of them.

    Repeated rows multiply. They are counted on each side before the join and the product
    is returned as ``copies``, so that ``n`` equal rows on both sides never become ``n * n``
    joined pairs; :func:`expand_copies` writes them out. With ``unique=True`` the caller
    states that no side repeats a row, and the counting is skipped.
    """
    on = list(on)

    def side(df, vector, count):
        rows = df.select(*on, F.col(features).alias(vector))
        if unique:
            return rows.withColumn(count, F.lit(1).cast("bigint"))
        return rows.groupBy(*on, vector).agg(F.count(F.lit(1)).alias(count))

    a = side(first, "__a", "__na").alias("a")
    b = side(second, "__b", "__nb").alias("b")
    ends = [(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in on]
    same = ends[0][0] == ends[0][1]
    if len(on) > 1:
        same = reduce(lambda x, y: x & y, [x.eqNullSafe(y) for x, y in ends])
    return a.join(dealt(b), same, "inner").select(
        *[F.col(f"a.{c}").alias(c) for c in on],
        F.concat("__a", "__b").alias(features),
        (F.col("__na") * F.col("__nb")).alias("copies"),
    )


_CHUNK = 10_000


def expand_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Write a row out ``copies`` times, in chunks so that no array grows with the count."""
    chunks = F.ceil(F.col(copies) / _CHUNK).cast("bigint")
    left = F.least(F.col(copies) - F.col("__chunk") * _CHUNK, F.lit(_CHUNK))
    spread = df.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)))
    return spread.withColumn("__i", F.explode(F.array_repeat(F.lit(0), left.cast("int")))).drop(
        "__chunk", "__i", copies
    )


def name_features(
    df: DataFrame, n: int, key: str = "name", label: str = "label", features: str = "features"
) -> DataFrame:
    """Wide table ``MOLECULE_NAME, LABEL, FEATURE_1..n``. Only sinks need this form."""
    wide = [F.get(F.col(features), F.lit(i)).alias(f"FEATURE_{i + 1}") for i in range(n)]
    return df.select(F.col(key).alias(META[0]), F.col(label).alias(META[1]), *wide)
