"""Envelopes as a stream: each micro-batch is routed, sorted, split and written.

A batch that fails runs again from its checkpointed offsets and replaces its own files. What it takes for
the present is noted beside the checkpoint when the batch first runs, so that a second run after midnight
writes the same rows to the same paths. Flow control is the source's bound on a batch; stopping drains
nothing that is not in the checkpoint already.

`start_strict` puts buffers per path in between, which flush at exact counts, sizes and ages.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltlake.config import Config
from siltlake.functions import coerce
from siltlake.functions.shared import hadoop_path
from siltlake.observe import METRICS, flush_summary
from siltlake.operators.route import Template, pipeline_path
from siltlake.plans import ingest
from siltlake.streaming import buffer

log = logging.getLogger(__name__)


def batch_clock(spark: SparkSession, checkpoint: str, batch: int) -> datetime:
    """When the batch first ran: the name of an empty file holds it. Notes of earlier batches are dropped."""
    system, folder = hadoop_path(spark, f"{checkpoint.rstrip('/')}/siltlake-clock")
    noted = {}
    if system.exists(folder):
        for status in system.listStatus(folder):
            n, micros = status.getPath().getName().split("-")
            noted[int(n)] = (int(micros), status.getPath())
    if batch not in noted:
        now = int(datetime.now(timezone.utc).timestamp() * 1e6)
        at = hadoop_path(spark, f"{checkpoint.rstrip('/')}/siltlake-clock/{batch}-{now}")[1]
        system.mkdirs(folder)
        system.create(at).close()
        noted[batch] = (now, at)
    for n, (_, at) in noted.items():
        if n < batch - 1:
            system.delete(at, False)
    return datetime.fromtimestamp(noted[batch][0] / 1e6, timezone.utc)


def _writer(config: Config, checkpoint: str, reason: str, on_flush, prepare=lambda df: df):
    def flush(df: DataFrame, batch: int) -> None:
        try:
            with METRICS.timed("flush"):
                written = ingest.write(prepare(df), config, batch, batch_clock(df.sparkSession, checkpoint, batch))
        except Exception:
            METRICS.add("flushes", reason=reason, result="failed")
            raise
        METRICS.flushed(written, reason)
        log.info("batch %s: %s", batch, flush_summary(written))
        if on_flush:
            on_flush(batch, written)

    return flush


def start(stream: DataFrame, config: Config, checkpoint: str, available_now: bool = False, on_flush=None) -> StreamingQuery:
    """Start writing. available_now: process what is there and end; else a batch every timeout_secs."""
    writer = stream.writeStream.foreachBatch(_writer(config, checkpoint, "batch", on_flush)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{config.buffer.timeout_secs} seconds")
    return writer.start()


def start_strict(stream: DataFrame, config: Config, checkpoint: str, available_now: bool = False, on_flush=None) -> StreamingQuery:
    """The same through a buffer for each path (see siltlake.streaming.buffer). Columns of `stream`: those of an
    envelope and, if some rows are commands to flush, `force`. Needs the RocksDB state store."""
    template = Template(config.key_prefix)
    parsed = coerce.parse(stream, template.reads())
    forced = F.coalesce(F.col("force"), F.lit(False)) if "force" in stream.columns else F.lit(False)
    # a command's value is the path itself
    path = F.when(forced, F.col("value")).otherwise(pipeline_path(template))
    routed = parsed.where(F.col("_valid") | forced).select(path.alias("_path"), "value", "partition", "offset", "timestamp", forced.alias("force"))
    flushed = buffer.flushes(routed, config.buffer)

    def envelopes(df: DataFrame) -> DataFrame:
        return df.select(F.explode("messages").alias("m")).select("m.*")

    writer = flushed.writeStream.outputMode("append").foreachBatch(_writer(config, checkpoint, "buffer", on_flush, envelopes)).option("checkpointLocation", checkpoint)
    seconds = max(1.0, min(10.0, config.buffer.timeout_secs))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()
