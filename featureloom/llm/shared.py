"""Staged tables and row keys shared by the operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureloom.session import scratch_dir

LAST = (1 << 63) - 1


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: a cut that survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fitted(rows: DataFrame, fit: Callable[[pa.Table], Any]) -> Any:
    """What ``fit`` makes of the bounded sample ``rows``, in one task: the driver gets the model, not the sample (None without rows)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(fit(pa.Table.from_batches(got)))], pa.binary())})

    found = rows.coalesce(1).mapInArrow(task, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def whole_text(col: str | Column = "text") -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def hash_share(total: int, wanted: int, *cols: str) -> Column:
    """Whether a row belongs to a repeatable sample of about ``wanted`` of ``total`` rows."""
    steps = 1 << 30
    bound = steps if total <= wanted else max(1, steps * wanted // total)
    return F.pmod(F.xxhash64(*cols), F.lit(steps)) < bound
