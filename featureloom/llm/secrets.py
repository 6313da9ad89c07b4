"""Secret scans: three fixed patterns and a character Markov model, in DataFrame functions only.

The patterns (``assign``, ``access``, ``hex``) give the base spans. The model adds spans of kind ``model``: runs
of 16 or more token characters that meet no base span and look random. Two first-order Markov
models tell this, one of random strings and one of ordinary identifiers: a run is reported if
the log-likelihood ratio of its pairs of neighbouring characters passes a bound in sum and on average. Both are
trained on labelled samples of the corpus: random strings are the values of the base spans and digests of
the ids of the sampled documents, ordinary ones the words of these documents that meet no base span. Weights are
thousandths of the natural logarithm, rounded to integers, so scores do not depend on the
order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import whole_text

# The patterns of the base spans and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
ASSIGNED = 12
KINDS = ("assign", "access", "hex", "model")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE, WORD = "[A-Za-z0-9+/_=-]{16,}", "[A-Za-z0-9_-]{4,}"
SAMPLE, BLOCK = 4_000, 64
# A run is as likely random as ordinary at 0; e to the 12th is about 160,000 to one.
TOTAL, AVERAGE = 12_000, 1_400
# Pairs of one character say nothing about a string of few different ones, such as a line of dashes.
DIFFERENT = 6
_SPANS = "array<struct<start int, end int, value string>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans_of(text: Column, pattern: str, group: int = 0) -> Column:
    """``(start, end, value)`` of all matches from the left, in code points; ``value`` is a group of the match.

    What lies between the matches and the matches themselves give the places: their lengths are added up, first those of
    blocks of :data:`BLOCK` matches, then within each block, so that no long array is built item by item. No match
    may be empty. Only texts with a match are split.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # The last part is the rest of the text, without a match.
    parts = F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), values.alias("value")), lambda p: F.struct(
        F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("hit"), p["value"].alias("value")))
    parts = F.filter(parts, lambda p: p["hit"].isNotNull())
    empty = F.array().cast(_SPANS)

    def block(parts: Column, offset: Column) -> Column:
        step = lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["hit"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + p["gap"]).alias("start"), (acc["at"] + p["gap"] + p["hit"]).alias("end"), p["value"].alias("value")))).alias("out"),
        )
        return F.aggregate(parts, F.struct(offset.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    def walk(parts: Column) -> Column:
        last = F.floor((F.size(parts) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(parts, b * BLOCK + 1, BLOCK))
        return _let(blocks, lambda bs: _let(F.aggregate(  # where each block starts
            bs, F.array(F.lit(0)),
            lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(b, F.lit(0), lambda n, p: n + p["gap"] + p["hit"])))),
            lambda starts: F.flatten(F.transform(bs, lambda b, i: block(b, F.get(starts, i))))))

    return F.when(F.regexp_like(text, F.lit(pattern)), _let(parts, walk)).otherwise(empty)


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("."), F.lit(0))


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the arrays ``assign``, ``access`` and ``hex`` of ``(start, end, value)`` of a text without nulls."""
    assign = F.filter(spans_of(F.col(text), ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGNED)
    return df.withColumns({"assign": assign, "access": spans_of(F.col(text), ACCESS), "hex": spans_of(F.col(text), HEX)})


def _meets(spans: str, span: Column) -> Column:
    """Whether a span meets one of the sorted, disjoint ``spans``: the last of them that starts before its end, found by halving."""
    step = lambda at, p: F.when(F.get(spans, at + p)["start"] < span["end"], at + p).otherwise(at)
    last = F.aggregate(F.array(*[F.lit(1 << p) for p in reversed(range(30))]), F.lit(-1), step)
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, last)["end"] > span["start"], F.lit(False))


def _clear(span: Column) -> Column:
    """Whether a span meets no base span of its row."""
    return ~(_meets("assign", span) | _meets("access", span) | _meets("hex", span))


def _pairs(strings: DataFrame, sign: str) -> DataFrame:
    """``(a, b, n)``: how often character ``b`` follows ``a`` in the strings ``s``; ``a`` is empty at the start of one."""
    strings = strings.groupBy("s").agg(F.count("*").alias("k")).select("k", _characters(F.col("s")).alias("c"))
    pairs = F.transform("c", lambda c, i: F.struct(F.coalesce(F.get("c", i - 1), F.lit("")).alias("a"), c.alias("b")))
    return strings.select("k", F.inline(pairs)).groupBy("a", "b").agg(F.sum("k").alias(sign))


def sampled(docs: DataFrame, id_col: str, sample: int) -> DataFrame:
    """About ``sample`` documents, drawn by the MD5 of their ids; all, if they are not more."""
    total = docs.count()
    # Eight hexadecimal digits of the digest, as text: below the share of 16 ** 8 that is wanted.
    bound = "g" if total <= sample else f"{(sample << 32) // total:08x}"
    return docs.where(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8) < bound)


def fit_markov(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``(a, b, weight)`` for every pair of characters in the training strings: a table of at most 68 * 67 rows.

    ``weight`` is 1000 times the logarithm of the odds that ``b`` follows ``a`` in a random rather than an ordinary string,
    both with one added to every count. The sample is bounded by ``sample`` documents. Without documents there are no rows, and no
    run is reported then.
    """
    rows = sampled(docs, id_col, sample).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), whole_text(text_col).alias("t"))
    values = F.transform(F.concat("assign", "access", "hex"), lambda s: s["value"])
    digest = lambda salt: F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), F.col("id")), 256)))
    made = F.array(digest("a"), F.md5("id"), F.upper(F.regexp_replace(digest("b"), "[^A-Za-z0-9]", "")))
    random = base_spans(rows, "t").select(F.explode(F.concat(values, made)).alias("s"))
    rest = F.col("t")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = rows.select(F.explode(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))).alias("s"))
    signs = _characters(F.lit(ALPHABET))
    grid = docs.sparkSession.range(1).select(F.explode(F.concat(F.array(F.lit("")), signs)).alias("a")).select("a", F.explode(signs).alias("b"))
    # Tables of at most 68 * 67 rows from here on.
    counts = grid.join(_pairs(random, "r"), ["a", "b"], "left").join(_pairs(ordinary, "o"), ["a", "b"], "left").na.fill(0, ["r", "o"])
    totals = counts.groupBy("a").agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    one, size = F.lit(1.0), F.lit(float(len(ALPHABET)))
    odds = F.log((F.col("r") + one) / (F.col("rs") + size)) - F.log((F.col("o") + one) / (F.col("os") + size))
    return counts.join(totals, "a").select("a", "b", F.floor(odds * 1000 + 0.5).cast("int").alias("weight"))


def weights_literal(model: DataFrame) -> Column:
    """The model as one literal array: the weight of ``b`` after ``a`` at 128 times the ASCII code of ``a`` (0 at the start) plus that of ``b``."""
    table = [0] * (128 * 128)
    for r in model.collect():  # at most 68 * 67 rows
        table[128 * ord(r.a or "\0") + ord(r.b)] = r.weight
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def run_score(run: Column, weights: Column) -> Column:
    """The log-likelihood ratio of a run of characters of the alphabet, in thousandths."""
    step = lambda acc, c: F.struct(F.ascii(c).alias("a"), (acc["t"] + F.get(weights, acc["a"] * 128 + F.ascii(c))).alias("t"))
    return F.aggregate(_characters(run), F.struct(F.lit(0).alias("a"), F.lit(0).cast("bigint").alias("t")), step, lambda acc: acc["t"])


def find_secrets(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)``: every span of every text as ``(kind, start, end, value)``, by start, then kind as in :data:`KINDS`.

    Places are code points, the end exclusive. Null texts are empty; null and repeated ids are rows like others; other columns are
    not read; an empty table gives no rows. Equal texts have equal spans.
    """
    weights = weights_literal(model)
    varied = lambda run: F.size(F.array_distinct(_characters(run))) >= DIFFERENT
    rows = base_spans(docs.select(F.col(id_col), whole_text(text_col).alias("__t")), "__t")
    random = lambda s: (run_score(s["value"], weights) > F.greatest(F.lit(TOTAL), F.length(s["value"]) * AVERAGE)) & varied(s["value"]) & _clear(s)
    rows = rows.withColumn("model", F.filter(spans_of(F.col("__t"), CANDIDATE), random))
    tag = lambda i: lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"), s["value"].alias("value"))
    tagged = [F.transform(k, tag(i)) for i, k in enumerate(KINDS)]
    kinds = F.array(*map(F.lit, KINDS))
    name = lambda s: F.struct(F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    named = F.transform(F.array_sort(F.concat(*tagged)), name)
    return rows.select(F.col(id_col), named.alias("spans"))


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The spans of :func:`find_secrets` as counts of the base kinds, their digest and the text of all spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select(id_col, *map(count, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
