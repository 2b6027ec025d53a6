"""Length-prefixed logs: each record is an unsigned big-endian 32-bit length and that many bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "path string, record long, value string"


def records(data: bytes) -> Iterator[bytes]:
    """Whole records up to the end; a torn last record is left out."""
    at = 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return
        yield data[at + 4 : at + 4 + size]
        at += 4 + size


def append(data: bytes, record: bytes) -> bytes:
    return data + len(record).to_bytes(4, "big") + record


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the log files under path, in order within a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = [r.decode("utf-8", "replace") for r in records(content)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(range(len(found)), pa.int64()), pa.array(found, pa.string())], ["path", "record", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)
