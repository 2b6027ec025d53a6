"""Recorded envelopes: Parquet or JSON-lines files, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "value string, partition int, offset bigint, timestamp timestamp"


def batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(SCHEMA).format(fmt).load(path)


def stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMA).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input with fewer splits than the session has cores, dealt over all of them, so that parsing a few
    small files isn't left to a few tasks; larger inputs as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
