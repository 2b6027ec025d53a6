"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltlake.llm import chat, media, minhash, packing, quality, secrets, topk, toxicity, unigram
from siltlake.llm.common import read_table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(read_table(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_of_texts(read_table(spark, sf_dir, "documents"))


def sniff_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.sniffed_texts(read_table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encode_documents(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(read_table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), minhash.MinHashParams(words=2))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_media_columns": op3_media_columns,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_packing": op10_packing,
    "sniff_blobs": sniff_blobs,
}

SQL: dict[str, str] = {
    "op2_exact_top_k": topk.SQL,
    "op3_media_columns": media.SQL,
    "op4_chat_formatting": chat.SQL,
    "op9_minhash_near_dedup": minhash.SQL_TWO_WORDS,
    "sniff_blobs": media.SQL_BLOBS,
}
