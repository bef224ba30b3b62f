"""From raw documents to token digests of a mixed, clean corpus, stage by stage.

Every stage works on all rows the one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import bpe, jaccard, mixing, quality, secrets
from roadpulse.llm.batches import bound_batches
from roadpulse.llm.queries import BPE_RANKS, documents
from roadpulse.sources.storage import new_path, save, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the verdicts on their hosts keep."""
    return quality.verdicts(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    bound_batches(spark)
    return jaccard.keep_one(docs).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced; n_chars follows the text."""
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in random order."""
    return mixing.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document of the mix."""
    bound_batches(spark)
    return bpe.digests(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

#: Set similarity, the forest and tokens have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, apply in STAGES[:-1]:
        # Tables a stage keeps for itself go as soon as what it returns is written.
        with scratch(spark):
            docs = save(apply(spark, docs, sf_dir), new_path(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
