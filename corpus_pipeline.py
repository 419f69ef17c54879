"""Cleaning a corpus: quality, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir); its result is stored as Parquet and read again as
the next stage's documents. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import exact_dedup, jaccard_join, packing, private_data, quality
from claimloom.llm.shared import new_folder, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_accepted(docs, quality.fit(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "digest-index"))
    return exact_dedup.keep_first(docs, index)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return jaccard_join.keep_one(docs, jaccard_join.Settings(words=5, percent=80))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return private_data.mask_private(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", accepted),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("private_data", without_private_data),
    ("packing", packed),
]

# Tokens and trained models have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
