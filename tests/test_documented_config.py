"""A configuration as operators write it, key for key, drives an ingestion."""

import urllib.request

from pyspark.sql import functions as F

from siltlake import config, observe
from siltlake.config import JsonColumn
from siltlake.plans import ingest
from siltlake.read import table
from siltlake.sinks import files
from siltlake.streaming import buffer
from tests.test_operators import envelope

TEXT = """
data_dir: /mnt/lake/
metrics_port: 8075
sources:
  events: {type: kafka, topics: [clicks], bootstrap_servers: "localhost:9092", group_id: lake, auto_offset_reset: latest, tls: {enabled: false}}
sinks:
  local_events:
    type: filesystem
    inputs: [events]
    path: %s
    key_prefix: events/{{team_id}}/{{date}}/
    filename_extension: parquet
    disk_batching:
      max_events: 10000
      max_bytes: 104857600
      timeout_secs: 30
      backpressure: {max_pending_flushes: 7, high_watermark_bytes: 4000, low_watermark_bytes: 3000, max_concurrent_flushes: 4, max_open_files: 256, max_total_bytes: 5000}
    encoding:
      codec: parquet
      parquet:
        compression: zstd
        compression_level: 5
        rows_per_file: 2
        max_rows_per_row_group: 1000
        page_buffer_bytes: 65536
        use_file_buffer_pool: true
        allow_nullable_fields: true
        sorting_columns:
          - {column: event, descending: false}
          - {column: timestamp, descending: true}
        json_columns:
          - {column: properties, max_subcolumns: 1, bucket_count: 2, max_depth: 10, keep_original_column: true}
          - {column: more, max_subcolumns: 3, bucket_count: 1}
        dynamic_columns: {inserted_at: current_time, _timestamp: kafka_time, _offset: kafka_offset}
        schema:
          event: {type: utf8, bloom_filter: true}
          team_id: {type: int64, minmax_index: false}
          timestamp: {type: timestamp_ms}
          properties: {type: utf8}
          more: {type: utf8}
          inserted_at: {type: timestamp_ms}
          _offset: {type: int64}
"""


def test_documented_keys(spark, tmp_path):
    (tmp_path / "c.yml").write_text(TEXT % tmp_path.joinpath("out"))
    c = config.load(str(tmp_path / "c.yml"))
    assert (c.data_dir, c.key_prefix) == ("/mnt/lake/", "events/{{team_id}}/{{date}}/")
    b = c.buffer
    assert (b.max_events, b.max_bytes, b.timeout_secs, b.max_pending_flushes, b.high_watermark_bytes, b.low_watermark_bytes, b.max_total_bytes) == (10_000, 104_857_600, 30, 7, 4000, 3000, 5000)
    p = c.parquet
    assert p.json_columns == [JsonColumn("more", 3, 1, 5), JsonColumn("properties", 1, 2, 5)] and p.sort_columns == [("event", False), ("timestamp", True)]
    assert p.no_bounds == ["team_id"] and p.bloom_filters == ["event"] and c.dynamic_columns["inserted_at"] == "current_time"
    assert buffer.offsets_per_trigger(b, 96) == 10 and buffer.offsets_per_trigger(config.BufferConfig(), 1024) == 10_000_000
    values = ['{"event":"%s","team_id":5,"timestamp":"2024-01-02T03:04:0%dZ","properties":{"x":%d,"y":1},"more":{"z":true}}' % ("ba"[i % 2], i, i) for i in range(5)]
    from datetime import datetime, timezone

    now = datetime(2030, 1, 1, tzinfo=timezone.utc)
    done = ingest.write(envelope(spark, values), c, 3, now)
    assert sorted((w["path"], w["rows"]) for w in done) == [("events/5/2024/01/02/", 1), ("events/5/2024/01/02/", 2), ("events/5/2024/01/02/", 2)]
    df = table(spark, str(tmp_path / "out"))
    rows = df.select("event", "_offset", "`properties.x`", "`more.z`", F.unix_millis("inserted_at").alias("ms")).orderBy("_offset").collect()
    assert [(r.event, r["properties.x"], r["more.z"]) for r in rows] == [("ba"[i % 2], str(i), "true") for i in range(5)]
    assert {r.ms for r in rows} == {int(now.timestamp() * 1000)}


def test_a_sink_of_ones_own(spark, tmp_path):
    class Renamed:
        def __init__(self, base):
            self.inner = files.FileSink(base)

        def publish(self, path, name, write):
            return self.inner.publish("mine/" + path, name, write)

    files.SINKS["mine"] = lambda config, prefix: Renamed(config["path"])
    try:
        c = config.Config(key_prefix="e={{event}}/", sinks={"f": {"type": "filesystem", "path": str(tmp_path)}}, parquet=config.ParquetConfig(schema={"event": "utf8"}))
        sink = files.sink_of({"type": "mine", "path": str(tmp_path)})
    finally:
        del files.SINKS["mine"]
    df, declared = ingest.rows(envelope(spark, ['{"event":"a"}']), c)
    files.write_batch(df, sink, 0, c.parquet, declared)
    assert [p.parent.name for p in tmp_path.rglob("*.parquet")] == ["e=a"] and (tmp_path / "mine").is_dir()


def test_a_failing_writer_leaves_nothing(tmp_path):
    def broken(out):
        out.write(b"half")
        raise OSError("disk full")

    try:
        files.FileSink(str(tmp_path)).publish("p/", "x.parquet", broken)
    except OSError:
        pass
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []


def test_scraped_counters():
    r = observe.Registry()
    r.flushed([{"rows": 3, "bytes": 10}, {"rows": 2, "bytes": 5}], "time")
    r.add("flushes", reason="time", result="failed")
    with r.timed("flush"):
        pass
    server = r.serve(0)
    try:
        text = urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/metrics").read().decode()
    finally:
        server.shutdown()
    assert 'siltlake_flushes{reason="time",result="ok"} 1\n' in text and 'siltlake_flushes{reason="time",result="failed"} 1\n' in text
    assert "siltlake_files 2\n" in text and "siltlake_rows 5\n" in text and "siltlake_bytes_out 15\n" in text and 'siltlake_stage_seconds_bucket{stage="flush",le="+Inf"} 1\n' in text
