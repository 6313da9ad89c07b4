"""Logical records of delimited text whose quoted fields hold line breaks, in files that are still split.

Files are read line by line in splits. A line turns the state in which it begins (outside or
inside a quoted field) into the state in which it ends. Which state a split begins in is not known, so both are
followed; one row for each split then tells, over the splits of a file in order, in which state each begins
and how many records came before. Records that lie in one split are put together where they are read; only the lines of
a record that runs over the edge of a split meet by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def _ends_inside(text: Column, sep: str) -> Column:
    """Whether text that begins outside of a quoted field ends inside one; a quote opens a field only at its start."""
    s = "\\" + sep if sep != "\t" else "\\t"
    return F.regexp_replace(text, rf"(^|{s}){_QUOTED}", "$1").rlike(rf'(^|{s})"')


def line_states(value: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field if it begins outside of one, and if it begins inside."""
    closing = r'^[^"]*+(?:""[^"]*+)*+"'
    rest = F.regexp_replace(value, closing, "x")  # what follows the closing quote belongs to the same field
    quoted = value.contains('"')  # most lines have no quote and need no pattern
    return (F.when(quoted, _ends_inside(value, sep)).otherwise(F.lit(False)),
            F.when(quoted, ~value.rlike(closing) | _ends_inside(rest, sep)).otherwise(F.lit(True)))


_STATES = T.StructType([
    *[T.StructField(n, T.BooleanType()) for n in ("b0", "b1", "e0", "e1")], *[T.StructField(n, T.LongType()) for n in ("k0", "k1")],
])


def _follow(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """For lines in the order of the scan: the states before (b) and behind (e) a line, and the records begun so far (k).

    Once for a split that begins outside (0) and once for one that begins inside (1) of a quoted field. A line either keeps
    the state, turns it, or sets it; what it is after line i follows from the last line that set it and the turns since.
    """
    at, state, count = None, [False, True], [0, 0]
    for split, t0, t1, empty in batches:
        if not len(split):
            yield pd.DataFrame({n: [] for n in ("b0", "b1", "e0", "e1", "k0", "k1")})
            continue
        key = split.to_numpy()
        t0, t1, empty = t0.to_numpy(bool), t1.to_numpy(bool), empty.to_numpy(bool)
        out = {n: np.zeros(len(key), np.int64 if n[0] == "k" else bool) for n in ("b0", "b1", "e0", "e1", "k0", "k1")}
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for lo, hi in zip(edges, edges[1:]):
            if key[lo] != at:
                at, state, count = key[lo], [False, True], [0, 0]
            fixed = t0[lo:hi] == t1[lo:hi]
            turns = np.cumsum(t0[lo:hi] & ~t1[lo:hi]) % 2 == 1
            last = np.maximum.accumulate(np.where(fixed, np.arange(hi - lo), -1))
            base = np.where(last >= 0, t0[lo:hi][np.maximum(last, 0)] ^ turns[np.maximum(last, 0)], False)
            for x in (0, 1):
                end = np.where(last >= 0, base, state[x]) ^ turns
                begin = np.concatenate([[state[x]], end[:-1]])
                starts = np.cumsum(~begin & ~empty[lo:hi]) + count[x]
                out[f"b{x}"][lo:hi], out[f"e{x}"][lo:hi], out[f"k{x}"][lo:hi] = begin, end, starts
                state[x], count[x] = bool(end[-1]), int(starts[-1])
        yield pd.DataFrame(out)


# It sees the lines in order, so no filter may be moved in front of it.
_followed = F.pandas_udf(_follow, _STATES).asNondeterministic()


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Lines with what ended them, and their states for both ways in which their split may begin."""
    cut = F.split("value", r"\r(?!\z)", -1)  # a return before a line feed belongs to that
    several = F.transform(cut, lambda v, i: F.struct(
        F.regexp_replace(v, r"\r\z", "").alias("value"),
        F.when(i < F.size(cut) - 1, "\r").when(v.endswith("\r"), "\r\n").otherwise("\n").alias("end")))
    one = F.array(F.struct("value", F.lit("\n").alias("end")))
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.inline(F.when(F.col("value").contains("\r"), several).otherwise(one)),
    ).withColumn("id", F.monotonically_increasing_id())
    t0, t1 = line_states(F.col("value"), sep)
    return lines.withColumn("f", _followed(F.xxhash64("file", "start"), t0, t1, F.col("value") == "")).select("file", "start", "id", "value", "end", "f.*")


def record_starts(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``(file, start, inside, before, last, open, records)``: a staged row for each split of the files at ``path``.

    Whether the split begins inside of a record, the records begun before it and up to its end, whether it ends inside of one, and
    the records of the whole file.
    """
    lines = _lines(spark, path, sep)
    ends = lines.groupBy("file", "start").agg(F.max_by(F.struct("e0", "e1", "k0", "k1"), "id").alias("z")).select("file", F.struct("start", "z").alias("s"))
    begin = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("bigint").alias("before"),
                     F.array().cast("array<struct<start:bigint,inside:boolean,before:bigint,last:bigint,open:boolean>>").alias("all"))
    pick = lambda acc, s, x: F.when(acc["inside"], s["z"][f"{x}1"]).otherwise(s["z"][f"{x}0"])
    step = lambda acc, s: F.struct(
        pick(acc, s, "e").alias("inside"), (acc["before"] + pick(acc, s, "k")).alias("before"),
        F.concat(acc["all"], F.array(F.struct(
            s["start"].alias("start"), acc["inside"].alias("inside"), acc["before"].alias("before"),
            (acc["before"] + pick(acc, s, "k")).alias("last"), pick(acc, s, "e").alias("open")))).alias("all"))
    # One entry for each split of a file.
    splits = ends.groupBy("file").agg(F.sort_array(F.collect_list("s")).alias("s")).select("file", F.aggregate("s", begin, step).alias("a"))
    return stage(splits.select("file", F.col("a")["before"].alias("records"), F.inline(F.col("a")["all"])), "splits")


_RECORDS = "file string, record_no bigint, value string"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from lines ``(file, record_no, value, end)`` in the order of the scan; the lines of a record follow one another."""
    names, held, parts, tail = ["file", "record_no", "value"], None, [], ""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, number = batch.column("file").dictionary_encode(), batch.column("record_no").to_numpy(zero_copy_only=False)
        code = file.indices.to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.flatnonzero((number[1:] != number[:-1]) | (code[1:] != code[:-1])) + 1])
        inner = np.ones(n, bool)
        inner[np.append(first[1:], n) - 1] = False  # the line end behind a record is none of its text
        ends = pc.if_else(pa.array(inner), batch.column("end"), pa.scalar(""))
        lines = pc.binary_join_element_wise(batch.column("value"), ends, "")
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(first, n), pa.int32()), lines), "")
        files, numbers = pc.take(batch.column("file"), pa.array(first)), number[first]
        key = (files[0].as_py(), int(numbers[0]))
        lo = 0
        if held == key:
            parts += [tail, text[0].as_py()]
            lo = 1
        if held is not None and (lo == 0 or len(first) > 1):
            yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]], pa.int64()), pa.array(["".join(parts)])], names=names)
            held = None
        if held is None:
            # The last record may go on in the next batch.
            held, parts = (files[-1].as_py(), int(numbers[-1])), [text[-1].as_py()]
        tail = batch.column("end")[n - 1].as_py()
        hi = len(first) - 1
        if hi > lo:
            yield pa.RecordBatch.from_arrays([files[lo:hi], pa.array(numbers[lo:hi], pa.int64()), text[lo:hi]], names=names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]], pa.int64()), pa.array(["".join(parts)])], names=names)


def logical_records(spark: SparkSession, path: str, sep: str, starts: DataFrame | None = None) -> DataFrame:
    """``(file, record_no, value)``: every logical record of the files at ``path``, numbered from 1 in each file.

    Blank lines outside of quoted fields are no records. Line ends inside a field stay what they are. A quoted
    field that is never closed takes the rest of its file, as in any reader. Files split as plain text does. ``starts`` are those
    of :func:`record_starts`, if they are known already: they have a row for each split, which every task gets.
    """
    starts = record_starts(spark, path, sep) if starts is None else starts
    known = _lines(spark, path, sep).join(F.broadcast(starts), ["file", "start"], "left")
    # Splits follow from the number of cores; rows must not be lost if that changes between two scans.
    known = known.withColumn("inside", F.coalesce("inside", F.raise_error(F.lit("the splits have changed since the first scan")).cast("boolean")))
    of = lambda x: F.when(F.col("inside"), F.col(f"{x}1")).otherwise(F.col(f"{x}0"))
    known = known.filter(of("b") | of("e") | (F.col("value") != "")).withColumn("record_no", F.col("before") + of("k"))
    edge = (F.col("record_no") == F.col("before")) | (F.col("open") & (F.col("record_no") == F.col("last")))
    whole = known.filter(~edge).select("file", "record_no", "value", "end").mapInArrow(_assembled, _RECORDS)
    parts = known.filter(edge).groupBy("file", "record_no").agg(F.sort_array(F.collect_list(F.struct("id", "value", "end"))).alias("p"))
    text = F.array_join(F.transform("p", lambda p, i: F.concat(p["value"], F.when(i < F.size("p") - 1, p["end"]).otherwise(""))), "")
    return whole.unionByName(parts.select("file", "record_no", text.alias("value")))
