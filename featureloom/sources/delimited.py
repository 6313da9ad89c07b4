"""Defensive scan of delimited text: separator, header, malformed records, verified table."""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import named
from .lines import number_lines
from .records import logical_records

# Candidate separators; a tie goes to the earlier one.
SEPARATORS = (",", ";", "\t")
# Fixed value: characters at the start of the file that decide the separator.
SAMPLE_CHARS = 2048

BAD = "_bad"


def _first_file(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the start of the first file (by name)."""
    try:
        files = sorted(map(unquote, spark.read.text(path).inputFiles()))
    except AnalysisException as e:
        raise ValueError(f"cannot read {path}: {e}") from e
    if not files:
        raise ValueError(f"no file at {path}")
    return spark.read.text(files[0]).filter("_metadata.file_block_start = 0").select("value")


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """The separator that occurs most often in the first 2048 characters.

    Every line has at least its line end, so as many lines cover the sample.
    """
    cut = F.substring("value", 1, SAMPLE_CHARS).alias("value")
    lines = _first_file(spark, path).select(cut).limit(SAMPLE_CHARS).collect()
    sample = "\n".join(r.value for r in lines)[:SAMPLE_CHARS]
    if not sample.strip():
        raise ValueError(f"{path} is empty")
    return max(SEPARATORS, key=sample.count)


def expected_columns(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Header names; their number is the width every record must have."""
    header = _first_file(spark, path).first()
    if header is None:
        raise ValueError(f"{path} is empty")
    return next(csv.reader([header.value.lstrip("\ufeff")], delimiter=sep))


def field_count(raw, sep: str) -> Column:
    """Fields of a raw record, quoted ones counted once; a blank record has none."""
    c = F.col(raw) if isinstance(raw, str) else raw
    s = "\\" + sep if sep != "\t" else "\\t"
    bare = F.regexp_replace(c, rf'(?s)(^|{s})"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.when(c == "", 0).otherwise(
        F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    )


def read_delimited(
    spark: SparkSession, path: str, sep: str | None = None, names: list[str] | None = None,
    multi_line: bool | str = False, starts: DataFrame | None = None,
) -> DataFrame:
    """All records as strings, plus ``_bad`` (raw text of records of another width) and ``ord``.

    ``ord`` orders the records as in the input: file, start of the split, position in it.
    Quoted fields with line breaks need ``multi_line``: ``True`` keeps a file in one task, ``"split"`` finds the
    records over the splits of a file, see :func:`logical_records`, with the ``starts`` of :func:`record_starts` if these are known. Every
    file must have the header of the first one (unless ``names`` are given): the scan fails where
    columns stand in another order.
    """
    sep = sep or detect_delimiter(spark, path)
    same_header = names is None
    names = names or expected_columns(spark, path, sep)
    if len(set(names)) != len(names):
        raise ValueError(f"repeated column names in the header: {names}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, BAD)])
    if multi_line == "split":
        return _parse_records(logical_records(spark, path, sep, starts), schema, sep, names if same_header else None)
    rows = (
        spark.read.schema(schema)
        .options(sep=sep, header=True, mode="PERMISSIVE", quote='"', escape='"',
                 columnNameOfCorruptRecord=BAD, multiLine=multi_line, maxCharsPerColumn=-1,
                 enforceSchema=not same_header,
                 # With pruning, the width of a record would be judged by the columns in use.
                 columnPruning=False)
        .csv(path)
    )
    # A scan that asks for the raw text alone is refused, so a data column stands behind it.
    raw = F.when(F.col(BAD).isNotNull(), F.coalesce(F.col(BAD), named(names[0])))
    return rows.select(
        *[named(n) for n in names],
        raw.alias(BAD),
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"),
        ).alias("ord"),
    )


def _parse_records(records: DataFrame, schema: T.StructType, sep: str, header: list[str] | None) -> DataFrame:
    """:func:`read_delimited` of logical records; ``ord`` is file and record number. ``header`` is what each first record must be."""
    options = {"sep": sep, "mode": "PERMISSIVE", "quote": '"', "escape": '"', "columnNameOfCorruptRecord": BAD, "multiLine": "true", "maxCharsPerColumn": "-1"}
    fields = F.from_csv("value", F.lit(schema.simpleString() if all(n.isidentifier() for n in schema.names) else schema.toDDL()), options)
    first = F.col("record_no") == 1
    if header is not None:
        names = F.split(F.regexp_replace(F.col("value"), r'^\ufeff|"', ""), F.lit("\\" + sep if sep != "\t" else "\\t"))
        other = first & (names != F.array(*[F.lit(n.replace('"', "")) for n in header]))
        first = F.when(other, F.raise_error(F.concat(F.lit("another header in "), "file")).cast("boolean")).otherwise(first)
    rows = records.filter(~first).withColumn("r", fields)
    r = F.col("r")
    return rows.select(
        *[r[n].alias(n) for n in schema.names[:-1]], F.when(r[BAD].isNotNull(), F.col("value")).alias(BAD),
        F.struct(F.col("file").alias("path"), F.lit(0).cast("bigint").alias("start"), F.col("record_no").alias("id")).alias("ord"),
    )


def split_malformed(
    df: DataFrame, sep: str, short_rows: str = "pad"
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of a :func:`read_delimited` table.

    Records with too many fields are always rejected. Short ones are padded with nulls, or
    rejected with ``short_rows="reject"``.
    """
    if short_rows not in ("pad", "reject"):
        raise ValueError(f"short_rows must be 'pad' or 'reject', not {short_rows!r}")
    names = [c for c in df.columns if c not in (BAD, "ord")]
    found = field_count(BAD, sep)
    bad = F.col(BAD).isNotNull()
    if short_rows == "pad":
        bad = bad & (found > len(names))
    good = df.filter(~bad).drop(BAD)
    rejects = df.filter(bad).select(
        F.col("ord")["path"].alias("file"), F.col(BAD).alias("raw"),
        F.lit(len(names)).alias("expected"), found.alias("found"),
    )
    return good, rejects


def malformed_records(
    spark: SparkSession, path: str, sep: str | None = None, expected: int | None = None,
    short_rows: str = "pad", multi_line: bool | str = False,
) -> DataFrame:
    """``(file, record_no, raw, expected, found, kept)`` of every record of another width.

    ``record_no`` is 1-based with the header as record 1. ``kept`` tells whether the record
    stays in the data, padded. Only malformed lines are joined with the line numbers. With
    ``multi_line`` records come from the reader of :func:`read_delimited`: a quoted line break does
    not end a record, and blank lines are none.
    """
    sep = sep or detect_delimiter(spark, path)
    expected = expected or len(expected_columns(spark, path, sep))
    if multi_line == "split":
        return _malformed_split(spark, path, sep, expected, short_rows)
    if multi_line:
        return _malformed_logical(spark, path, sep, expected, short_rows)
    found = field_count("value", sep)
    lines = number_lines(spark.read.text(path), keep=found != expected)
    pad = F.lit(short_rows == "pad")
    return lines.select(
        "file", (F.col("line_no") + 1).alias("record_no"), F.col("value").alias("raw"),
        F.lit(expected).alias("expected"), found.alias("found"),
        (pad & (found < expected) & (found > 0)).alias("kept"),
    )


def _malformed_split(spark: SparkSession, path: str, sep: str, expected: int, short_rows: str) -> DataFrame:
    """:func:`malformed_records` by logical record, over the splits of every file."""
    found = field_count(BAD, sep)
    rows = read_delimited(spark, path, sep, multi_line="split").filter(F.col(BAD).isNotNull())
    kept = F.lit(short_rows == "pad") & (F.col("found") < expected) & (F.col("found") > 0)
    return rows.select(
        F.col("ord")["path"].alias("file"), F.col("ord")["id"].alias("record_no"), F.col(BAD).alias("raw"),
        F.lit(expected).alias("expected"), found.alias("found"),
    ).withColumn("kept", kept)


def _malformed_logical(
    spark: SparkSession, path: str, sep: str, expected: int, short_rows: str
) -> DataFrame:
    """:func:`malformed_records` by logical record; a file is one split, so its ids are consecutive."""
    rows = read_delimited(spark, path, sep, multi_line=True)
    first = rows.groupBy(F.col("ord")["path"].alias("file")).agg(F.min(F.col("ord")["id"]).alias("first"))
    found = field_count(BAD, sep)
    bad = rows.filter(F.col(BAD).isNotNull()).select(
        F.col("ord")["path"].alias("file"), F.col("ord")["id"].alias("id"), F.col(BAD).alias("raw"), found.alias("found")
    )
    pad = F.lit(short_rows == "pad")
    return bad.join(first, "file").select(
        "file", (F.col("id") - F.col("first") + 2).alias("record_no"), "raw", F.lit(expected).alias("expected"), "found",
        (pad & (F.col("found") < expected) & (F.col("found") > 0)).alias("kept"),
    )
