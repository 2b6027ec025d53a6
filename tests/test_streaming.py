from pyspark.sql import functions as F

from siltlake.config import BufferConfig, Config, ParquetConfig
from siltlake.read import table
from siltlake.sources import replay
from siltlake.streaming import buffer, ingest


def feed(spark, path, lo, hi):
    df = spark.range(lo, hi).select(F.concat(F.lit('{"event":"e'), (F.col("id") % 2).cast("string"), F.lit('"}')).alias("value"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


def test_restart_from_checkpoint(spark, tmp_path):
    src, out, point = (str(tmp_path / n) for n in ("in", "out", "point"))
    c = Config(key_prefix="e={{event}}/", sinks={"f": {"type": "filesystem", "path": out}}, parquet=ParquetConfig(schema={"event": "utf8", "_offset": "int64"}, rows_per_file=3))
    seen = []
    for lo, hi in ((0, 10), (10, 15)):
        feed(spark, src, lo, hi)
        ingest.start(replay.stream(spark, src), c, point, available_now=True, on_flush=lambda b, w: seen.append((b, sum(x["rows"] for x in w)))).awaitTermination()
    assert seen == [(0, 10), (1, 5)]
    assert sorted(r._offset for r in table(spark, out).collect()) == list(range(15))


def test_strict_buffers(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src = str(tmp_path / "in")
    feed(spark, src, 0, 11)
    df = replay.stream(spark, src).withColumn("_path", F.get_json_object("value", "$.event"))
    out = buffer.flushes(df, BufferConfig(max_events=3, timeout_secs=3600))
    q = out.writeStream.format("memory").queryName("flushed").outputMode("append").option("checkpointLocation", str(tmp_path / "point")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = sorted((r.path, r.flush, r.reason, r.events, r.bytes) for r in spark.table("flushed").collect())
    size = 3 * (len('{"event":"e0"}') + 4)
    assert rows == [("e0", 0, "size", 3, size), ("e0", 1, "size", 3, size), ("e1", 0, "size", 3, size)]


def test_byte_limits():
    assert list(buffer.flush_bytes([46, 1, 1, 100, 1], 10, 50)) == [0, 1, 1, 1, 2]
    assert list(buffer.flush_bytes([1] * 5, 2, 10**9)) == [0, 0, 1, 1, 2]


def test_buffers_write_their_flushes_and_can_be_forced(spark, tmp_path):
    """Size, age and command: every message is written once, and none stays behind."""
    import time

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src, out, point = (str(tmp_path / n) for n in ("in", "out", "point"))
    c = Config(key_prefix="e={{event}}/", sinks={"f": {"type": "filesystem", "path": out}}, parquet=ParquetConfig(schema={"event": "utf8", "_offset": "int64"}), buffer=BufferConfig(max_events=4, timeout_secs=3))
    columns = ["value", "partition", "offset", "timestamp"]
    feed(spark, src, 0, 11)
    seen = []
    q = ingest.start_strict(replay.stream(spark, src), c, point, on_flush=lambda b, w: seen.extend(x["rows"] for x in w))
    try:
        end = time.time() + 90
        while sum(seen) < 11 and time.time() < end:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted(seen) == [1, 2, 4, 4]  # two full buffers; what is left of each is written when its time is up
    assert sorted(r._offset for r in table(spark, out).collect()) == list(range(11))
    # a command flushes at once, however long the timeout is
    src, out, point = (str(tmp_path / n) for n in ("in2", "out2", "point2"))
    c = Config(key_prefix="e={{event}}/", sinks={"f": {"type": "filesystem", "path": out}}, parquet=c.parquet, buffer=BufferConfig(max_events=100, timeout_secs=3600))
    feed(spark, src, 0, 5)
    commands = spark.createDataFrame([("e=e0/", -1, -1, None), ("e=e1/", -1, -1, None)], "value string, partition int, offset long, timestamp timestamp")
    done = []
    stream = replay.stream(spark, src).withColumn("force", F.col("partition") < 0)
    q = ingest.start_strict(stream, c, point, on_flush=lambda b, w: done.extend(w))
    try:
        time.sleep(1)
        commands.select(columns).coalesce(1).write.mode("append").parquet(src)
        end = time.time() + 90
        while sum(x["rows"] for x in done) < 5 and time.time() < end:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted(r._offset for r in table(spark, out).collect()) == list(range(5))


def test_a_batch_keeps_its_clock(spark, tmp_path):
    point = str(tmp_path / "point")
    first = ingest.batch_clock(spark, point, 4)
    assert ingest.batch_clock(spark, point, 4) == first
    ingest.batch_clock(spark, point, 5)
    ingest.batch_clock(spark, point, 6)
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "point" / "siltlake-clock").iterdir() if not p.name.startswith(".")) == ["5", "6"]
