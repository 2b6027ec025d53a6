import pytest
from pyspark.sql import functions as F

from siltlake import config, observe
from siltlake.config import Config, JsonColumn, ParquetConfig
from siltlake.functions import coerce
from siltlake.operators import enrich, layout, route, shred
from siltlake.plans import ingest
from siltlake.read import json_field, table
from siltlake.sinks import files
from siltlake.sources import kafka


def test_shredding_example(spark):
    texts = ['{"a":1,"b":"x","c":{"d":1.50}}', '{"a":2.0,"c":{"d":"z"}}', '{"a":3,"arr":[1,{"y":1,"x":"<"}]}', "", "{}", "[1]"]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "i int, file int, p string")
    plan = shred.plan(shred.key_stats(shred.flattened(df, "p", 4), ["file"]), ["file"], 2)
    assert [(r.key, r.rows, r.type, r.max_depth, r.placement) for r in plan.orderBy("key").collect()] == [
        ("a", 3, "float64", 0, "subcolumn"), ("arr", 1, "string", 0, "overflow"), ("b", 1, "string", 0, "overflow"), ("c.d", 2, "string", 1, "subcolumn")]
    assert shred.subcolumn_names("p", plan) == ["p.a", "p.c.d"]
    rows = {r.i: r for r in shred.shred(df, "p", ["file"], 2, 4).collect()}
    assert [rows[i]._sub for i in (0, 1, 2, 4)] == [{"a": "1", "c.d": "1.50"}, {"a": "2", "c.d": "z"}, {"a": "3"}, {}]
    assert rows[0]._buckets == {2: '{"b":"x"}'} and rows[2]._buckets == {2: '{"arr":"[1,{\\"x\\":\\"\\\\u003c\\",\\"y\\":1}]"}'}
    assert [rows[i]._keys for i in range(6)] == ['["a","b","c.d"]', '["a","c.d"]', '["a","arr"]', None, "[]", None]
    assert rows[3]._sub is None and rows[5]._buckets is None
    alone = shred.shred(df.where("i = 0"), "p", ["file"], 9, 4).first()
    assert alone._sub["c.d"] == "1.5"  # a plan of its own: the key is a float there


@pytest.mark.parametrize("values, stored", [
    (["1", "2.5"], ["1", "2.5"]), (["1", '"x"'], ["1", "x"]), (["true", "0"], ["true", "0"]), (["null", "7"], [None, "7"]), (['""', "7"], [None, "7"]), (['""', "null"], [None, None]),
    (["18446744073709551615", "5"], ["18446744073709551615", "5"]), (["1e3", "2"], ["1000", "2"]), (["[1, 2]", "3"], ["[1,2]", "3"])])
def test_type_conflicts(spark, values, stored):
    df = spark.createDataFrame([(i, 0, '{"k":' + v + "}") for i, v in enumerate(values)], "i int, file int, p string")
    assert [r._sub["k"] for r in shred.shred(df, "p", ["file"], 5, 4).orderBy("i").collect()] == stored


def test_depth(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":%s}}}}}}'
    df = spark.createDataFrame([(0, deep % 1), (1, deep % '{"g":1}')], "file int, p string")
    a, b = shred.shred(df, "p", ["file"], 5, 4).orderBy("file").collect()
    assert a._sub == {"a.b.c.d.e.f": "1"} and a._buckets == {}
    assert b._sub == {} and b._buckets == {0: '{"a.b.c.d.e.f.g":1}'} and b._keys == '["a.b.c.d.e.f.g"]'


def routed(spark, text, template, **more):
    t = route.Template(template)
    df = coerce.parse(spark.createDataFrame([(text,)], "value string"), t.reads())
    return df.select(route.pipeline_path(t, now=F.lit("2030-05-06").cast("timestamp"), **more).alias("p")).first().p


def test_routing(spark):
    t = "team={{team_id}}/date={{date}}/event={{event}}/"
    assert routed(spark, '{"team_id":123,"event":"click","timestamp":"2024-01-02T03:04:05Z"}', t) == "team=123/date=2024/01/02/event=click/"
    assert routed(spark, '{"event":null,"timestamp":"2024-01-02"}', t) == "team=0/date=2024/01/02/event=null/"
    assert routed(spark, '{"team_id":"7","timestamp":1704067200000}', t) == "team=0/date=2030/05/06/event=/"
    assert routed(spark, '{"timestamp":1704067200000}', "{{date}}", numeric_time=True) == "2024/01/01"
    assert routed(spark, '{"x":true,"y":[1, 2],"z":7.9}', "{{x}}/{{y}}/{{z}}/{{a.b}}/") == "true/[1,2]/7/{{a.b}}/"
    assert routed(spark, '{"x":".."}', "a/{{x}}/b") == "a/__/b" and routed(spark, "{}", "static/") == "static/" and routed(spark, "{}", "") == ""
    df = spark.createDataFrame([('{"team_id":123}',), ("not valid json",)], "value string")
    t = route.Template("team={{team_id}}/event={{event}}/")
    assert [r.p for r in df.select(route.generic_path(t).alias("p")).collect()] == ["team=123/event=/", "team=/event=/"]
    e = df.withColumn("timestamp", F.lit(1)).select(route.parse_event(t).alias("e")).first().e
    assert e.fields == {"team_id": "123"} and e.partition_path == "team=123/event=/"


def test_dynamic_columns():
    assert enrich.dynamic_columns(None) == {"_timestamp": "kafka_time", "_offset": "kafka_offset", "_partition": "kafka_partition"}
    assert enrich.dynamic_columns({"_timestamp": "CURRENT_TIME", "z": "kafka_time", "a": "Kafka_Offset", "bad": "x"}) == {"_timestamp": "current_time", "_offset": "kafka_offset", "_partition": "kafka_partition", "a": "kafka_offset", "z": "kafka_time"}


def test_sorting_example(spark):
    rows = ['{"event":"b","n":1}', '{"event":"a","n":null}', '{"event":"a","n":2}', '{"n":5}', '{"event":"a","n":10}']
    df = coerce.parse(spark.createDataFrame([(i, 0, r) for i, r in enumerate(rows)], "_offset long, _partition int, value string"), ["event", "n"]).withColumn("_path", F.lit("p"))
    out = layout.with_file_index(df, 2, keys=layout.sort_keys([("event", False), ("n", True)]))
    assert [(r._offset, r._file) for r in out.orderBy("_row").collect()] == [(3, 0), (4, 0), (2, 1), (1, 1), (0, 2)]


def test_numbering_spans_partitions(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("_path"), (F.lit(0)).alias("_partition"), (4999 - F.col("id")).alias("_offset"))
    rows = layout.with_file_index(df, 700).orderBy("_path", "_offset").collect()
    for path in ("hot", "cold"):
        assert [r._row for r in rows if r._path == path] == list(range(sum(r._path == path for r in rows)))
    assert max(r._file for r in rows) == 3999 // 700


def envelope(spark, values):
    return spark.createDataFrame([(v, 0, i) for i, v in enumerate(values)], "value string, partition int, offset long").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def conf(base, **p):
    return Config(key_prefix="e={{event}}/", sinks={"f": {"type": "filesystem", "path": str(base)}}, parquet=ParquetConfig(**p))


def test_written_files(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    values = ['{"event":"a","p":{"x":%d,"y":"%d"}}' % (i, i) for i in range(5)] + ["not-json", '{"event":"b","p":{"z":1}}']
    p = dict(schema={"event": "utf8", "p": "json", "n": "int64"}, json_columns=[JsonColumn("p", 1, 3)], rows_per_file=2, max_rows_per_row_group=1, no_bounds=["event"])
    done = ingest.write(envelope(spark, values), conf(tmp_path, **p), 7)
    assert sorted((w["path"], w["rows"]) for w in done) == [("e=a/", 1), ("e=a/", 2), ("e=a/", 2), ("e=b/", 1)]
    again = ingest.write(envelope(spark, values), conf(tmp_path, **p), 7)
    assert sorted(w["name"] for w in again) == sorted(w["name"] for w in done)
    found = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    assert len(found) == 4
    f = pq.ParquetFile(sorted(x for x in found if "e=a" in x)[0])
    assert f.schema_arrow.names == ["event", "n", "p", "p.x", "p__json_keys", "p__json_type_bucket_0", "p__json_type_bucket_1", "p__json_type_bucket_2"]
    assert f.metadata.num_row_groups == 2 and f.metadata.row_group(0).column(0).compression == "ZSTD" and not f.metadata.row_group(0).column(0).is_stats_set
    df = table(spark, str(tmp_path))
    assert sorted(str(r.v) for r in df.select(json_field(df, "p", "y", 3).alias("v")).collect()) == ["0", "1", "2", "3", "4", "None"]
    assert sorted(str(r.v) for r in df.select(json_field(df, "p", "z", 3).alias("v")).collect()) == ["1", "None", "None", "None", "None", "None"]


def test_name_clash_is_an_error(spark, tmp_path):
    p = dict(schema={"event": "utf8", "p": "json", "p.x": "utf8"}, json_columns=[JsonColumn("p", 1, 3)])
    with pytest.raises(Exception, match="p.x"):
        ingest.write(envelope(spark, ['{"event":"a","p":{"x":1}}']), conf(tmp_path, **p))


def test_undeclared_json_column_gives_empty_parts(spark, tmp_path):
    p = dict(schema={"event": "utf8"}, json_columns=[JsonColumn("p", 1, 2)])
    ingest.write(envelope(spark, ['{"event":"a","p":{"x":1}}']), conf(tmp_path, **p))
    assert table(spark, str(tmp_path)).first().asDict() == {"event": "a", "p__json_keys": None, "p__json_type_bucket_0": None, "p__json_type_bucket_1": None}


def test_empty_batch_writes_nothing(spark, tmp_path):
    assert ingest.write(envelope(spark, ["x"]).limit(0), conf(tmp_path, schema={"event": "utf8"})) == []


def test_configuration(tmp_path):
    c = config.from_dict({})
    assert (c.data_dir, c.metrics_port, c.buffer.max_events, c.buffer.max_bytes, c.parquet.rows_per_file, c.parquet.compression_level) == ("/data/", 8075, 100_000, 10 << 30, 10_000, 5)
    assert (c.buffer.high_watermark_bytes, c.buffer.low_watermark_bytes) == (40 << 30, 30 << 30)
    (tmp_path / "c.yml").write_text("""
key_prefix: "e={{event}}/"
buffer: {max_events: 5, max_total_bytes: 1000, low_watermark_bytes: 900}
sources: {b: {type: kafka, bootstrap_servers: "h2", topics: [t]}, a: {type: kafka, bootstrap_servers: "h1:1, h3", topics: [x, y], auto_offset_reset: earliest, tls: {enabled: true}}}
sinks: {z: {type: filesystem, path: /x}, s: {type: aws_s3, bucket: b, prefix: /q/}}
parquet:
  rows_per_file: 3
  schema: {event: utf8, blob: {type: json, minmax_index: false}}
  json_columns: [{name: blob, max_subcolumns: 2, max_depth: 3}]
  sort_columns: [{column: event, descending: true}]
""")
    c = config.load(str(tmp_path / "c.yml"))
    assert c.source()["name"] == "a" and c.sink()["type"] == "aws_s3" and files.sink_of(c.sink()).base == "s3a://b/q"
    assert c.buffer.low_watermark_bytes == 480 and c.parquet.no_bounds == ["blob"] and c.parquet.json_columns == [JsonColumn("blob", 2, 256, 5)] and c.parquet.sort_columns == [("event", True)]
    o = kafka.options(c.source(), 10)
    assert o["kafka.bootstrap.servers"] == "h1:1,h3" and o["subscribe"] == "x,y" and o["startingOffsets"] == "earliest" and o["kafka.security.protocol"] == "SSL" and o["maxOffsetsPerTrigger"] == "10"
    assert config.bootstrap_servers("a:1,\n b:2 \n") == ["a:1", "b:2"]
    for bad in ("", " ,\n"):
        with pytest.raises(config.ConfigError):
            config.bootstrap_servers(bad)
    with pytest.raises(config.ConfigError):
        files.sink_of({"type": "ftp"})
    assert files.codec("zstd", 3) == ("zstd", 3) and files.codec("", 1) == ("none", None) and files.codec("odd", 0) == ("zstd", 5)
    assert files.spark_options(ParquetConfig(no_bounds=["x"]))["parquet.column.statistics.enabled#x"] == "false"


def test_metrics(spark):
    df, o = observe.observed(coerce.parse(spark.createDataFrame([('{"a":1}',), ("bad",), (None,)], "value string"), ["a"]))
    df.collect()
    assert o.get == {"received": 3, "bytes_in": 10, "processed": 1, "parse_errors": 2}
    h = observe.histogram(spark.range(10), F.col("id"), [4, 8])
    assert {r.bound: r.observations for r in h.collect()} == {4.0: 5, 8.0: 9, None: 10}
    assert observe.exposition({"rows": 3}) == "# TYPE siltlake_rows counter\nsiltlake_rows 3\n"
    assert observe.log_level("warn") == 30 and observe.log_level("odd") == 20
