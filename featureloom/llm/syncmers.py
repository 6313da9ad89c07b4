"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is its words (runs without white space, cut after 24 characters; Chinese and Japanese
characters are words of their own). A k-mer is ``K`` words, an s-mer ``S`` words. A k-mer is a
closed syncmer if the least hash of its s-mers is that of the first or the last one; this
depends on nothing outside the k-mer, so two texts that share it choose it in both, wherever
it stands. The fingerprint holds the ``SIZE`` least syncmer hashes; likeness is the Jaccard
estimate from two of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureloom.llm.shared import partitions, staged, whole_text

K, S, SIZE = 6, 2, 64
SPAN = K - S + 1  # s-mers of a k-mer
FIRST = -(1 << 63)
_WORD = r"[぀-ヿ㐀-鿿]|[^\s぀-ヿ㐀-鿿]{1,24}"


def _with_smers(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__h`` (word hashes) and ``__s`` (s-mer hashes, one for each word but the last)."""
    words = F.regexp_extract_all(F.col(text), F.lit(_WORD), F.lit(0))
    df = df.withColumn("__h", F.transform(words, lambda w: F.xxhash64(w)))
    pairs = F.transform("__h", lambda h, i: F.xxhash64(h, F.get("__h", i + 1)))
    return df.withColumn("__s", F.slice(pairs, 1, F.greatest(F.size("__h") - 1, F.lit(0))))


def _closed(i: Column) -> Column:
    """Whether the k-mer at s-mer ``i`` (from 1) is a closed syncmer."""
    ends = F.least(F.get("__s", i - 1), F.get("__s", i + (SPAN - 2)))
    return ends == F.array_min(F.slice("__s", i, SPAN))


def _places() -> Column:
    n = F.size("__s") - (SPAN - 1)
    return F.filter(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), _closed)


def with_syncmers(df: DataFrame, text_col: str = "text", into: str = "syncmers") -> DataFrame:
    """``df`` with the syncmers of each text: an array of (word number from 0, hash).

    A null text has an empty array, as has one of fewer than ``K`` words. Other columns are kept; the
    names ``__t``, ``__h`` and ``__s`` are taken.
    """
    df = _with_smers(df.withColumn("__t", whole_text(text_col)), "__t")
    one = lambda i: F.struct((i - 1).alias("at"), F.xxhash64(F.slice("__s", i, SPAN)).alias("hash"))
    return df.withColumn(into, F.transform(_places(), one)).drop("__t", "__h", "__s")


def with_sketch(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with the ``SIZE`` least distinct 31-bit syncmer hashes of a text without nulls, ascending.

    A text with words but without syncmers (they are sure from ``K + 3`` words on) has one hash, that of all its
    words; a text without words has none.
    """
    df = _with_smers(df, text)
    high = lambda h: F.shiftrightunsigned(h, 33).cast("int")
    hashes = F.transform(_places(), lambda i: high(F.xxhash64(F.slice("__s", i, SPAN))))
    short = F.when(F.size("__h") > 0, F.array(high(F.xxhash64("__h")))).otherwise(F.array().cast("array<int>"))
    least = F.slice(F.array_sort(F.array_distinct(hashes)), 1, SIZE)
    some = F.transform(F.array(least), lambda x: F.when(F.size(x) > 0, x).otherwise(short))  # bound once, not computed twice
    return df.withColumn(into, F.get(some, F.lit(0))).drop("__h", "__s")


def sketch_text(sketch: str) -> Column:
    """The sketch as text, eight hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Share of the least hashes of both that both hold (1 for two empty sketches)."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, SIZE)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / F.greatest(F.lit(1), F.size(least)))


def neighbours(ids: DataFrame) -> DataFrame:
    """Distinct ids ``(o, n, th, mth)`` with ``prev_o``, ``prev_n``, ``prev_th``, ``prev_mth`` of the id before, the first behind the last.

    Ids are dealt to ranges and written, so that a range keeps its number; within a range a window
    gives the id before, and a table with one row for each range that before its first.
    """
    ranged = staged(ids.repartitionByRange(partitions(ids), "o").withColumn("r", F.spark_partition_id()), "id-ranges")
    one = F.struct("o", "n", "th", "mth")
    rows = ranged.withColumn("prev", F.lag(one).over(Window.partitionBy("r").orderBy("o")))
    ends = ranged.groupBy("r").agg(F.max_by(one, "o").alias("last"))
    along, all_ = Window.orderBy("r"), Window.orderBy("r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("r", F.coalesce(F.lag("last").over(along), F.last("last").over(all_)).alias("before"))
    rows = rows.join(F.broadcast(ends), "r").withColumn("prev", F.coalesce("prev", "before"))  # as many rows as shuffle partitions
    return rows.select("o", "n", "th", "mth", *[F.col("prev")[c].alias(f"prev_{c}") for c in ("o", "n", "th", "mth")])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and the likeness to that and to the next document.

    ``text_hash`` (xxhash64 of the text) tells the rows of a repeated id apart.

    The edited text has its last floor(n / 2) code points replaced by the first as many, or all, of the
    next document by id (after the last: the first). Null texts are empty; a null id comes first
    and stays null (the least long is reserved for it). The rows of a repeated id all have the next
    distinct id as theirs, which is represented by the text with the least hash. Further columns are not
    read; an empty table gives no rows; of one row the next document is itself.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("o"), whole_text(text_col).alias("t"))
    base = base.withColumn("th", F.xxhash64("t")).withColumn("n", F.length("t"))
    ids = base.groupBy("o").agg(F.max("n").alias("n"), F.min("th").alias("th"), F.max("th").alias("mth"))
    near = neighbours(ids).select("o", "prev_o", "prev_n", "prev_th", "prev_mth", F.col("n").alias("most"), "th")
    # Sketches are made once, beside the texts, and written. Texts are dealt by (id, hash), so the texts of an id that
    # very many rows have lie in many tasks; one exchange of them serves all joins, which need the same columns of it.
    sketches = staged(with_sketch(base, "t", "f").select("o", "th", "f"), "sketches").dropDuplicates(["o", "th"])
    near = near.join(sketches.withColumnRenamed("f", "next_f"), ["o", "th"])
    texts = base.repartition(partitions(docs), "o", "th")
    given = texts.join(near, ["o", "th"]).where(F.col("n") <= F.col("most"))
    given = given.select(
        F.col("prev_o").alias("o"), F.col("prev_th").alias("th"), "prev_mth", F.substring("t", F.lit(1), F.floor(F.col("prev_n") / 2).cast("int")).alias("head"), "next_f")
    half = F.floor(F.col("n") / 2).cast("int")
    # An id with one text gets the head of the next document under its own (id, hash). The different texts of a
    # repeated id get one row each, with no more of the head than they take.
    single = given.where("th = prev_mth").drop("prev_mth").dropDuplicates(["o", "th"])
    several = base.select("o", "th", "n").join(ids.where("th <> mth").select("o"), "o", "left_semi").distinct()
    heads = given.where("th <> prev_mth").select("o", "head", "next_f").dropDuplicates(["o"])
    several = several.join(heads, "o").select("o", "th", F.substring("head", F.lit(1), half).alias("head"), "next_f")
    own = sketches.withColumnRenamed("f", "own_f")
    met = [texts.join(x, ["o", "th"]).join(own, ["o", "th"]) for x in (single, several)]
    edited = F.concat(F.substring("t", F.lit(1), F.col("n") - half), F.substring("head", F.lit(1), half))
    rows = met[0].unionByName(met[1]).withColumnRenamed("own_f", "f")
    rows = with_sketch(rows.select("o", "th", "n", "f", "next_f", edited.alias("e")), "e", "g")
    return rows.select(
        F.when(F.col("o") != FIRST, F.col("o")).alias(id_col), F.col("n").cast("long").alias("n_chars"), F.sha2("e", 256).alias("edited_sha256"),
        sketch_text("f").alias("fingerprint"), sketch_text("g").alias("edited_fingerprint"),
        likeness("f", "g").alias("near_edited"), likeness("f", "next_f").alias("near_next"), F.col("th").alias("text_hash"),
    )
