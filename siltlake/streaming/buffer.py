"""Buffers per path with exact triggers: a flush as soon as a path holds max_events messages or
max_bytes bytes (four more than its text for each message), when its first message is timeout_secs old,
or when a command to flush the path arrives (`force`), as before a shutdown. State is kept by Spark per
path and survives a restart.

What a path holds is bounded by max_bytes and max_events; max_total_bytes, over all paths, is kept by the
bound on a micro-batch that the source gets (`offsets_per_trigger`), since Spark takes in the next batch
only when the last one has been buffered or written.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from siltlake.config import BufferConfig

MESSAGE = StructType([StructField("value", StringType()), StructField("partition", IntegerType()), StructField("offset", LongType()), StructField("timestamp", TimestampType())])
FLUSHED = StructType([
    StructField("path", StringType()), StructField("flush", LongType()), StructField("reason", StringType()), StructField("events", LongType()),
    StructField("bytes", LongType()), StructField("messages", ArrayType(MESSAGE))])
HEADER = 4


def offsets_per_trigger(config: BufferConfig, message_bytes: int = 1024) -> int:
    """How many messages of about so many bytes a micro-batch may take in, so that neither a full buffer of each
    pending flush nor the share of max_total_bytes between the two watermarks is exceeded."""
    room = config.max_total_bytes - config.high_watermark_bytes or config.max_total_bytes
    return max(1, min(config.max_events * config.max_pending_flushes, room // (message_bytes + HEADER)))


class PathBuffer(StatefulProcessor):
    def __init__(self, config: BufferConfig):
        self.config = config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", MESSAGE)
        self.size = handle.getValueState("size", StructType([StructField("events", LongType()), StructField("bytes", LongType()), StructField("flush", LongType())]))

    def _drop_timers(self) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)

    def _row(self, path: str, reason: str, flush: int, messages: list[tuple], size: int) -> dict:
        return {"path": path, "flush": flush, "reason": reason, "events": len(messages), "bytes": size, "messages": [dict(zip(MESSAGE.names, m)) for m in messages]}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events, size, flush = self.size.get() if self.size.exists() else (0, 0, 0)
        before = events  # of which the list state holds the messages
        fresh: list[tuple] = []

        def taken(reason: str) -> dict:
            nonlocal events, size, flush, before, fresh
            old = [tuple(m) for m in self.held.get()] if before else []
            row = self._row(key[0], reason, flush, old + fresh, size)
            self.held.clear()
            events, size, flush, before, fresh = 0, 0, flush + 1, 0, []
            return row

        for part in rows:
            out = []
            names = [part[n].tolist() for n in (*MESSAGE.names, "force")]
            for value, partition, offset, time, force in zip(*names):
                if force:
                    if events:
                        out.append(taken("force"))
                    continue
                fresh.append((value, partition, offset, time))
                events, size = events + 1, size + len(value.encode("utf-8", "surrogatepass")) + HEADER
                if events >= self.config.max_events or size >= self.config.max_bytes:
                    out.append(taken("size"))
            if out:
                yield pd.DataFrame(out)
        if fresh:
            self.held.appendList(fresh)
        if events and not before:  # a buffer's first message starts its clock
            self._drop_timers()
            splay = random.uniform(-1, 1) * self.config.timeout_splay_secs
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + max(1, int(1000 * (self.config.timeout_secs + splay))))
        elif not events:
            self._drop_timers()
        self.size.update((events, size, flush))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events, size, flush = self.size.get() if self.size.exists() else (0, 0, 0)
        if events:
            yield pd.DataFrame([self._row(key[0], "time", flush, [tuple(m) for m in self.held.get()], size)])
            self.held.clear()
            self.size.update((0, 0, flush + 1))

    def close(self) -> None:
        pass


def flushes(messages: DataFrame, config: BufferConfig) -> DataFrame:
    """messages: a stream with _path, value and, if they are there, partition, offset, timestamp and force (flush this
    path). Rows out: path, flush, reason, events, bytes, messages. Needs the RocksDB state store."""
    columns = [F.col(f.name).cast(f.dataType) if f.name in messages.columns else F.lit(None).cast(f.dataType) for f in MESSAGE]
    force = F.coalesce(F.col("force"), F.lit(False)) if "force" in messages.columns else F.lit(False)
    rows = messages.select("_path", *(c.alias(f.name) for c, f in zip(columns, MESSAGE)), force.alias("force"))
    return rows.groupBy("_path").transformWithStateInPandas(PathBuffer(config), FLUSHED, "Append", "processingTime")


def flush_bytes(sizes: Iterator[int], max_events: int, max_bytes: int) -> Iterator[int]:
    """Which flush each message of one path falls into, given the messages' sizes in order."""
    events = held = flush = 0
    for n in sizes:
        yield flush
        events, held = events + 1, held + n + HEADER
        if events >= max_events or held >= max_bytes:
            events = held = 0
            flush += 1
