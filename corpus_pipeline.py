"""From raw documents to token ids: drop bad texts, drop near copies, mix sources, encode."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.functions.session import shared_folder
from tidewell.llm import bpe, mixing, neardup, quality

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these, doesn't reject."""
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity of 0.8 or more."""
    return neardup.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mixed(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    decoded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_dedup", minhash_dedup),
    ("source_mixing", source_mixing),
    ("byte_level_bpe", byte_level_bpe),
]

# The classifier and the hash of signatures are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again.

    The folder ``corpus-<id>`` there belongs to the caller, who may delete it
    when the returned frame has been read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
