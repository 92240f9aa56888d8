"""The operators applied to whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.functions.session import shared_folder
from tidewell.llm import ann, bpe, collocations, counts, ctw, kdtree, mixing, neardup, ordering, postings, quality, reversed_search, shards

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CONTEXT_TOKENS = 1024
END_OF_TEXT = 50256  # free in the rank file
ORDER_KEY = 42
SHARDS = 40


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN), RANKS)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER).withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    items = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_text"),
    )
    cut = shards.by_bytes(items, "size", ["text_crc32", "_text", "doc_id"], SHARDS, group=["text_crc32", "_text"])
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per record written: its slot and place, and digests of what was read back from the shards."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    path = f"{shared_folder(spark)}/training-order-{uuid.uuid4().hex}"
    made = ordering.materialise(encoded, path, length=CONTEXT_TOKENS, key=ORDER_KEY, end_id=END_OF_TEXT)
    row = F.col("slot") - F.col("shard").cast("long") * made["stride"]
    written = spark.read.schema("slot long, sequence long, n_tokens int, record binary, shard int").parquet(path)
    return written.select(
        "slot", "sequence", "shard", row.alias("row_in_shard"), (row * (2 * CONTEXT_TOKENS)).alias("byte_offset"), "n_tokens",
        F.octet_length("record").alias("n_bytes"), F.sha2("record", 256).alias("record_sha256"),
    )


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda key: F.pmod(key, F.lit(20)) == 0, k=20)


def op8_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.exact_top_k(table(spark, sf_dir, "embeddings"), lambda key: F.pmod(key, F.lit(50)) == 0, k=5)


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.held_out_scores(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = postings.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, first=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_token_counts": op2_token_counts,
    "op3_quality": op3_quality,
    "op4_shards": op4_shards,
    "op5_minhash": op5_minhash,
    "op6_training_order": op6_training_order,
    "op7_ann": op7_ann,
    "op8_kdtree": op8_kdtree,
    "op9_ctw": op9_ctw,
    "op10_mixing": op10_mixing,
    "op11_phrase_index": op11_phrase_index,
    "op12_reversed_search": op12_reversed_search,
    "op13_collocations": op13_collocations,
}
