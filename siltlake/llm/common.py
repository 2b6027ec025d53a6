"""What the operators share: shared-folder tables, batch slicing, labels."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.shared import discard, materialise, scratch, shared_root

__all__ = ["bloom_join", "discard", "held_out", "materialise", "read_table", "scratch", "shared_root", "slices", "training_ids"]


@contextlib.contextmanager
def bloom_join(spark: SparkSession):
    """Let Spark put a Bloom filter of a join's small side, up to 64 MB of it, before the large side's
    exchange whatever the large side's size (by itself it does so from 10 GB on)."""
    own = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
    }
    was = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the Python objects made from one stay few."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def held_out(doc_id) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, label) of at most `bound` labelled rows outside the held-out fifth: those with the
    least hash of the id, so that the choice is the same at every run. Contradicting repeats of a
    doc_id are averaged and rounded up; nulls and values other than 0 and 1 don't count."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
