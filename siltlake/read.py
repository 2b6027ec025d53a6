"""Reading what the engine wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions import murmur
from siltlake.operators.shred import bucket_column


def table(spark: SparkSession, base: str) -> DataFrame:
    """All files below base; their schemas differ in subcolumns and are merged by name."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(base)


def json_field(df: DataFrame, column: str, key: str, buckets: int = 256) -> Column:
    """A shredded key wherever it was put: its subcolumn, else its bucket. The value is a text."""
    bucket = bucket_column(column, murmur.bucket(key, buckets))
    parts = []
    if f"{column}.{key}" in df.columns:
        parts.append(F.col(f"`{column}.{key}`"))
    if bucket in df.columns:
        parts.append(F.get_json_object(F.col(f"`{bucket}`"), f"$['{key}']"))
    return F.coalesce(*parts) if parts else F.lit(None).cast("string")
