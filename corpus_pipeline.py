"""A corpus from raw documents to packed sequences: five stages, each one operator of siltlake.llm.

toxicity        documents that the grammar's model rejects go
quality         documents that the positive-unlabelled model rejects go
near_duplicates one document of each component (five-word shingles, 0.8) stays
secrets         spans of secrets are replaced in the texts
packing         token sequences of 4096, one row per piece

Each stage works on all rows and columns that its predecessor kept, and on an empty table gives an empty
one with the same columns. Null texts are empty texts: neither toxic nor copies nor secrets; quality
scores them like any text. Rows without a doc_id are kept by near_duplicates. Where a doc_id stands for
several texts, each text is a document of its own: the one with the least MD5 sum goes by the doc_id,
the others come after all ids in the choice of which copy stays. Rows with the same id and text are
one document; of rows that differ in other columns the one whose JSON form sorts first stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm import minhash, packing, quality, secrets, toxicity
from siltlake.llm.common import discard, materialise, read_table, scratch

#: Held against brute force in tests/llm: SQL can't express the trained stages.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch() as keep:
        # whole rows go in one column, so that no name of theirs can clash
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
        digest = F.md5(F.coalesce("text", F.lit("")))
        one = rows.where("id is not null").withColumn("digest", digest)
        repeated = materialise(one.groupBy("id").agg(F.count("*").alias("n"), F.min("digest").alias("least")).where("n > 1").select("id", "least"), "repeated-ids")
        other_id = F.lit(1 << 62) + F.pmod(F.xxhash64("id", "digest"), F.lit(1 << 61))
        named = one.join(repeated, "id", "left").withColumn("key", F.when(F.col("least") != F.col("digest"), other_id).otherwise(F.col("id")))
        found = minhash.near_duplicates(named.select(F.col("key").alias("doc_id"), "text"), minhash.MinHashParams(words=5))
        kept = materialise(found.where("kept").select(F.col("doc_id").alias("key")).distinct(), "kept")
        stays = named.join(kept, "key", "left_semi")
        again = stays.where("least is not null").groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row"))
        out = stays.where("least is null").select("row").union(again.select("row")).union(rows.where("id is null").select("row")).select("row.*")
        keep.append(out := materialise(out, "without-copies"))
    return out


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_copies), ("secrets", hide_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch() as keep:
            before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
            keep.append(docs)
        discard(before)
    return docs
