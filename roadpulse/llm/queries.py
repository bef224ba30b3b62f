"""The named queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import bpe, centroids, conversations, hash_forest, jaccard, language, licenses, mixing, packing, passages, quality, secrets, warc
from roadpulse.llm.batches import bound_batches

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
BPE_TOKENIZER = "byte_bpe_50k.json"


#: Where Python workers find this package if the session was started elsewhere; a cluster gets it by --py-files.
SOURCE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", SOURCE_ROOT)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to the square roots of their sources' sizes, at the size of the corpus."""
    return mixing.mix(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; digests of both."""
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License templates that documents hold."""
    return licenses.scan(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document rules and host verdicts."""
    return quality.report(documents(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages predicted by filters learned from three quarters of the labelled documents."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language.fit(docs.where(F.col("doc_id").isNotNull() & ~held_out))
    return language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through WARC archives and back."""
    return warc.archive_report(_read(spark, sf_dir, "pages"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret with the forest's verdict."""
    return secrets.report(documents(spark, sf_dir))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that links of Jaccard 0.8 or more on five-word shingles connect."""
    return jaccard.classes(documents(spark, sf_dir))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words that occur elsewhere."""
    return passages.report(documents(spark, sf_dir))


def op10_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors to every fiftieth."""
    return hash_forest.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations with the cheapest repair of each."""
    return conversations.report(conversations.damage(_read(spark, sf_dir, "conversations")))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1,024 tokens."""
    return packing.report(documents(spark, sf_dir), public_tokenizers.path(BPE_TOKENIZER))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors after ten rounds in whole numbers."""
    return centroids.report(_read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_byte_bpe, op3_licenses, op4_quality_rules, op5_language, op6_warc, op7_secrets, op8_ngram_jaccard, op9_passages,
        op10_hash_forest, op11_conversations, op12_packing, op13_centroids,
    )
}
ORACLES: dict[str, str] = {
    "op1_mixing": mixing.SQL, "op3_licenses": licenses.sql(), "op4_quality_rules": quality.SQL, "op6_warc": warc.SQL,
    "op11_conversations": conversations.sql(), "op13_centroids": centroids.sql(),
}
