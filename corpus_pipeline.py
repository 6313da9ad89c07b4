"""A corpus pipeline of five stages, each on all that the one before it kept.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``. The two classifiers are fitted on the rows that the stage is given: the
quality classifier with the labels in ``sf_dir``, the language one with the column ``lang``.
Neither can be stated in SQL, so there is no ``ORACLE_SQL``; tests compare with brute force.

All stages read whole texts, keep every column of ``docs`` whatever its name, and return no rows for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureloom.llm import langid, packing, quality, simhash, suffixes
from featureloom.llm.shared import crc_fold, staged

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts have the score of the classifier's bias. Repeated rows share their fate. Of conflicting labels
    of a document the least counts; a null id has no label. Without labelled rows every document is kept.
    """
    labels = quality.one_label(spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    known = docs.where(crc_fold("doc_id", 3) != 1).select("doc_id", "text").join(labels, "doc_id")
    scored = quality.score_quality(docs.withColumn("__row", F.struct(*docs.columns)).select("__row", "text"), quality.fit_quality(known))
    return scored.where("predicted = 1").select("__row.*")


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told and not rejected.

    Null and empty texts and those without a letter have no language and go. Repeated rows share their fate; of equally
    near languages the first by name is told. Rows with a null ``lang`` or id are not learned from; without rows to
    learn from every document goes.
    """
    model = langid.fit_languages(docs.where(crc_fold("doc_id", 5) != 0))
    told = langid.predict_languages(docs.withColumn("__row", F.struct(*docs.columns)).select("__row", "text"), model)
    return told.where("not lang_rejected").select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    Null and empty texts form one group. A null id is the largest one; of rows with equal ids and linked texts one stays.
    """
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes that an earlier document has; a text may end up empty.

    Every row stays; a null text becomes empty. A null id counts as the largest; rows of one
    id cut nothing from each other. ``n_chars`` is counted anew.
    """
    out = suffixes.cut_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens.

    A null or empty text is one id. Rows of a repeated id are documents of their own.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
