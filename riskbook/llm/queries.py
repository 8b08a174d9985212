"""The registered queries of this package: each applies one operator, with its
production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.llm import bagminhash, hnsw, language, mixing, packing, pii, quality, repeats, sketches, spelling, token_files, toxicity, trie
from riskbook.llm.common import held_out, table, vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def op1_bagminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), vocabulary()))


def op3_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of three quarters of the ids."""
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_offending")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that start earlier, too."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 3, 1)
    model = language.fit(docs, ~out)
    found = language.predict(docs.select("doc_id", "text", out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_files.read_token_files(token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary()))


def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op9_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return sketches.edited_likeness(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants in the vocabulary of all documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_certified_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by cutoffs certified per language; odd crc32 of the id: holdout."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("lang"), held_out("doc_id", 2, 1))
    return judged.drop("broken_rules")


_ALL = [
    op1_bagminhash_dedup, op2_genetic_packing, op3_toxicity_mil, op4_source_mixing, op5_suffix_dedup, op6_language_id, op7_token_files,
    op8_pii_crf, op9_hnsw_search, op10_scaled_sketch, op11_spelling_variants, op12_conversation_trie, op13_certified_quality,
]
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}
ORACLE_SQL: dict[str, str] = {
    "op4_source_mixing": mixing.oracle_sql(),
    "op11_spelling_variants": spelling.oracle_sql(),
    "op12_conversation_trie": trie.oracle_sql(),
    "op13_certified_quality": quality.oracle_sql(),
}
