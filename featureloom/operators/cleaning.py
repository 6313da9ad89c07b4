"""Row and column cleaning over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import clean_key, fix_decimal_comma, is_decimal_comma, named, null_token


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """The table itself, or an error naming the columns it lacks. Runs no job."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df


def take_columns(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` columns."""
    return df.select(*[named(c) for c in df.columns[:n]])


def _strings(df: DataFrame, cols: list[str] | None) -> list[str]:
    if cols is not None:
        return list(cols)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _rewrite(df: DataFrame, cols: list[str], fn) -> DataFrame:
    changed = {c: fn(named(c)) for c in cols}
    return df.select(*[changed.get(c, named(c)).alias(c) for c in df.columns])


def fix_decimal_commas(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Repair decimal commas in the given (default: all) string columns."""
    return _rewrite(df, _strings(df, cols), fix_decimal_comma)


def decimal_comma_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, n)``: cells with a decimal comma, counted in one pass."""
    names = _strings(df, cols)
    return _per_column(df, {c: F.count_if(is_decimal_comma(named(c))) for c in names})


def _per_column(df: DataFrame, aggregates: dict) -> DataFrame:
    """One aggregate per column, returned as one ``(column, n)`` row each."""
    one_row = df.agg(F.array(*[
        F.struct(F.lit(name).alias("column"), agg.cast("bigint").alias("n"))
        for name, agg in aggregates.items()
    ]).alias("r"))
    return one_row.select(F.inline("r"))


def null_tokens(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing-value strings of the string columns become null."""
    return _rewrite(df, _strings(df, cols), null_token)


def clean_keys(df: DataFrame, col: str) -> DataFrame:
    """Clean the record key in ``col``."""
    return _rewrite(df, [col], clean_key)


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, n)``: nulls per column, counted in one pass."""
    return _per_column(df, {c: F.count_if(named(c).isNull()) for c in df.columns})


def drop_incomplete(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(complete rows, null counts per column)``."""
    whole = reduce(lambda a, b: a & b, [named(c).isNotNull() for c in df.columns])
    return df.filter(whole), null_counts(df)


def drop_null_features(
    df: DataFrame, n: int, label: str = "label", features: str = "features"
) -> DataFrame:
    """Rows with a label and a vector of exactly ``n`` non-null numbers."""
    f = F.col(features)
    return df.filter(
        F.col(label).isNotNull() & (F.size(f) == n) & ~F.exists(f, lambda x: x.isNull())
    )
