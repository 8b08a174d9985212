"""Corpus cleaning and packing: ``documents`` in, packed sequences out.

Each stage takes ``(spark, docs, sf_dir)``, where docs are the rows that the
stage before it kept, and returns a DataFrame. All but the last return the
columns of ``documents``; the last returns one row per packed piece. ``run``
writes each stage's result to the shared folder and hands the next stage the
files, so a lost executor costs at most the tasks of one stage.

* language_id: languages are learnt from the labelled rows at hand; documents that the
  model rejects (no letters, or far from every language) go.
* near_dedup: of each class of near duplicates one document stays.
* pii: spans of personal data are replaced by their kind in angle brackets;
  n_chars follows the text.
* source_mixing: sources are mixed to their target words; documents that the
  mix leaves out go, documents that it takes twice appear twice.
* packing: documents are packed into sequences of at most 1024 tokens.

Defined results: every stage returns exactly the columns doc_id, text, lang, source and n_chars (the last one: those of
a piece); other columns of the input, also ones with clashing names, are dropped by the first stage. Null and
empty texts have no language that the model knows and go with the first stage; a null doc_id is kept throughout (as an
empty id where ids are hashed); null lang rows are not learnt from, a null source is a source of its own. Of equal rows
one stays (near_dedup). An empty table gives an empty result in every stage.

SQL cannot express the learnt stages, so there is no oracle for the whole;
the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.llm import bagminhash, language, mixing, packing, pii
from riskbook.llm.common import prepare, stored, table, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = language.fit(docs, F.lit(True))
    return language.predict(docs.select(*COLUMNS), model).where("not rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bagminhash.one_of_each(docs.select(*COLUMNS))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    clean = pii.redact(docs.select(*COLUMNS), pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.apply_mix(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(packing.pieces(docs, vocabulary()))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", redact_pii),
    ("source_mixing", source_mixing),
    ("packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
