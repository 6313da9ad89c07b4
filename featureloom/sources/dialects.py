"""Folders whose files differ: each has its own separator and order of columns, found and read in one scan for all files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .delimited import SAMPLE_CHARS, SEPARATORS

# A dialect is a short row. Up to this many files their table is broadcast, beyond that it is joined by a shuffle.
BROADCAST_FILES = 10_000
BOM = "\ufeff"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        text = spark.read.text(path)
    except AnalysisException as e:
        raise ValueError(f"cannot read {path}: {e}") from e
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), "value",
    )


def _by_separator(sep: Column, one) -> Column:
    """``one(s)`` for the separator ``s`` that the row has; the others are not computed."""
    out = F.when(sep == SEPARATORS[0], one(SEPARATORS[0]))
    for s in SEPARATORS[1:]:
        out = out.when(sep == s, one(s))
    return out


def _fields_of(value: Column, s: str) -> Column:
    e = "\\t" if s == "\t" else "\\" + s
    raw = F.regexp_extract_all(F.concat(F.lit(s), value), F.lit(rf'(?s){e}("[^"]*+(?:""[^"]*+)*+"[^{e}]*|[^{e}]*)'), F.lit(1))
    quoted = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"$'
    return F.transform(raw, lambda f: F.when(f == "", F.lit(None)).when(
        f.rlike(quoted), F.replace(F.regexp_replace(f, quoted, "$1"), F.lit('""'), F.lit('"'))).otherwise(f))


def fields(value: Column, sep: Column) -> Column:
    """The fields of a record as an array: quotes around a whole field go, an empty bare field is null, ``""`` is empty text."""
    return _by_separator(sep, lambda s: _fields_of(value, s))


def _dialects(lines: DataFrame) -> DataFrame:
    # The first lines of a file by position: a group limit keeps at most SAMPLE_CHARS lines of each file and
    # task, cut to as many characters, in front of the shuffle. Every line has at least its line end.
    start = lines.filter("start = 0 AND value <> ''").withColumn("first", F.col("id"))
    order = Window.partitionBy("file").orderBy("id")
    top = start.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE_CHARS)
    cut = F.struct("k", F.substring("value", 1, SAMPLE_CHARS).alias("v"))
    files = top.groupBy("file").agg(
        F.min("first").alias("first"), F.max(F.when(F.col("k") == 1, F.col("value"))).alias("head"), F.sort_array(F.collect_list(cut)).alias("s"),
    )
    sample = F.substring(F.array_join(F.transform("s", lambda x: x["v"]), "\n"), 1, SAMPLE_CHARS)
    counts = [F.length("sample") - F.length(F.replace("sample", F.lit(s), F.lit(""))) for s in SEPARATORS]
    best = F.lit(SEPARATORS[-1])
    for i in range(len(SEPARATORS) - 2, -1, -1):  # a tie goes to the earlier one
        best = F.when(counts[i] == F.greatest(*counts), F.lit(SEPARATORS[i])).otherwise(best)
    found = files.withColumn("sample", sample).select("file", "first", "head", best.alias("sep"))
    head = F.regexp_replace("head", "^" + BOM, "")
    return found.select("file", "first", "sep", F.transform(fields(head, F.col("sep")), lambda f: F.coalesce(f, F.lit(""))).alias("header"))


def file_dialects(spark: SparkSession, path: str) -> DataFrame:
    """``(file, sep, header)``: one row for every file that has a line.

    The separator is the one that occurs most often in the first 2048 characters of the file, the header the fields of its first
    line that is not blank.
    """
    return _dialects(_lines(spark, path)).select("file", "sep", "header")


def read_dialects(
    spark: SparkSession, path: str, names: list[str] | None = None, short_rows: str = "pad",
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of all files at ``path``, each in its own dialect, by header name.

    ``good`` has the columns ``names`` as text, then ``sep`` of the file and ``ord`` (file, start of the split, position);
    a column of one of these two names is refused. Without ``names`` they are those of all headers, in the order of the
    first file by name that has them, and what a file lacks is null; with them, a file that lacks one fails the scan. A header that
    repeats a name fails it too. ``rejects`` is ``(file, raw, expected, found)`` as of :func:`split_malformed`: records
    with more fields than the header of their file has, with ``short_rows="reject"`` also those with fewer. Blank lines
    are no records; a quoted field ends with its line.
    """
    if short_rows not in ("pad", "reject"):
        raise ValueError(f"short_rows must be 'pad' or 'reject', not {short_rows!r}")
    lines = _lines(spark, path)
    dialects = _dialects(lines)
    given = names is not None
    if names is None:
        # One row for each column name, not for each file.
        heads = dialects.select("file", F.posexplode("header").alias("at", "name"))
        seen = heads.groupBy("name").agg(F.min(F.struct("file", "at")).alias("at")).orderBy("at").collect()
        names = [r["name"] for r in seen]
    if not names:
        raise ValueError(f"{path} is empty")
    if {"sep", "ord"} & set(names) or len(set(names)) != len(names):
        raise ValueError(f"column names that are repeated or reserved: {names}")
    header = F.col("header")
    bad = F.size(F.array_distinct(header)) < F.size(header)
    if given:
        bad = bad | (F.size(F.array_intersect(header, F.array(*map(F.lit, names)))) < len(names))
    stop = F.raise_error(F.concat(F.lit("header of "), "file", F.lit(": "), F.to_json(header))).cast("array<string>")
    dialects = dialects.withColumn("header", F.when(bad, stop).otherwise(header))
    if len(spark.read.text(path).inputFiles()) <= BROADCAST_FILES:
        dialects = F.broadcast(dialects)
    rows = lines.filter("value <> ''").join(dialects, "file").filter("id <> first").withColumn("f", fields(F.col("value"), F.col("sep")))
    over = F.size("f") > F.size("header")
    if short_rows == "reject":
        over = F.size("f") != F.size("header")
    rejects = rows.filter(over).select("file", F.col("value").alias("raw"), F.size("header").alias("expected"), F.size("f").alias("found"))
    # array_position is 0 for a name that the header lacks, and position -1 has no field
    value = lambda n: F.get("f", (F.array_position("header", n) - 1).cast("int")).alias(n)
    good = rows.filter(~over).select(
        *[value(n) for n in names], "sep", F.struct(F.col("file").alias("path"), "start", "id").alias("ord"))
    return good, rejects
