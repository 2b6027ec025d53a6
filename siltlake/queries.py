"""The engine's operators as registered queries over the test tables, and the same as SQL.

Messages are built from `events` by the same string concatenation on both sides, from integers and
texts only, over the whole table.
"""

from __future__ import annotations

import atexit
import contextlib
import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.config import Config, JsonColumn, ParquetConfig
from siltlake.functions import coerce
from siltlake.functions.shared import hadoop_path, new_folder
from siltlake.operators import enrich, layout, route, shred
from siltlake.plans import ingest
from siltlake.read import json_field, table
from siltlake.sources import replay
from siltlake.streaming import buffer
from siltlake.streaming import ingest as stream_ingest_plan

AMOUNT = """CASE CAST(event_id % 6 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN ',"amount":42.9' WHEN 2 THEN ',"amount":"42"' WHEN 3 THEN ',"amount":null' WHEN 4 THEN ',"amount":true' ELSE concat(',"amount":', CAST(event_id AS VARCHAR(20))) END"""
FLAG = """CASE CAST(event_id % 3 AS INTEGER) WHEN 0 THEN ',"flag":true' WHEN 1 THEN ',"flag":"true"' ELSE '' END"""
TEXT = """CASE CAST(event_id % 4 AS INTEGER) WHEN 0 THEN ',"note":""' WHEN 1 THEN ',"note":{"a":1}' WHEN 2 THEN ',"note":[1,2]' ELSE ',"note":"plain"' END"""
DAY = "concat(CAST(year(ts) AS VARCHAR(4)), '-', lpad(CAST(month(ts) AS VARCHAR(2)), 2, '0'), '-', lpad(CAST(day(ts) AS VARCHAR(2)), 2, '0'))"
CLOCK = "concat(lpad(CAST(hour(ts) AS VARCHAR(2)), 2, '0'), ':', lpad(CAST(minute(ts) AS VARCHAR(2)), 2, '0'), ':', lpad(CAST(CAST(floor(second(ts)) AS INTEGER) AS VARCHAR(2)), 2, '0'))"
VALUE = f"""CASE WHEN event_id % 97 = 0 THEN concat('broken{{', CAST(event_id AS VARCHAR(20))) ELSE concat('{{"team_id":', CAST(user_id AS VARCHAR(20)), ',"event":"', event_type, '","timestamp":"', {DAY}, 'T', {CLOCK}, 'Z","_offset":-1', {AMOUNT}, {FLAG}, {TEXT}, ',"properties":', props, '}}') END"""
MESSAGES = f'SELECT event_id AS "offset", CAST(event_id % 4 AS INTEGER) AS "partition", ts AS "timestamp", {VALUE} AS value FROM events'
GOOD = "event_id % 97 <> 0"

#: A nested document with conflicts of type, nulls and one key that is too deep.
NESTED = """concat('{"id":', CAST(event_id AS VARCHAR(20)),
 CASE CAST(event_id % 3 AS INTEGER) WHEN 0 THEN ',"mix":1' WHEN 1 THEN ',"mix":2.5' ELSE ',"mix":3' END,
 CASE CAST(event_id % 4 AS INTEGER) WHEN 0 THEN ',"odd":true' WHEN 1 THEN ',"odd":"x"' WHEN 2 THEN ',"odd":null' ELSE '' END,
 CASE WHEN event_id % 5 = 0 THEN ',"nil":null' ELSE '' END,
 ',"user":{"name":"', event_type, '","geo":{"zone":', CAST(user_id % 7 AS VARCHAR(20)), '}},"arr":[1,2]',
 CASE WHEN event_id % 6 = 0 THEN ',"a":{"b":{"c":{"d":{"e":{"f":{"g":1}}}}}}' ELSE '' END,
 CASE WHEN event_id % 50 = 0 THEN ',"url":"/p"' ELSE '' END, '}')"""

SCHEMA = {"team_id": "int64", "event": "utf8", "amount": "int64", "amount32": "int32", "flag": "bool", "note": "utf8", "properties": "json", "timestamp": "timestamp_ms", "score": "float64"}
TEMPLATE = route.Template("team={{team_id}}/date={{date}}/event={{event}}/")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.spread(spark.read.parquet(f"{sf_dir}/events.parquet"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = lambda text: text.replace('"offset"', "`offset`")
    return _events(spark, sf_dir).select(F.col("event_id").alias("offset"), F.expr("cast(event_id % 4 as int)").alias("partition"), F.col("ts").cast("timestamp").alias("timestamp"), F.expr(sql(VALUE)).alias("value"))


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", F.expr(NESTED).alias("p"), F.expr("cast(event_id % 3 as int)").alias("file"))


def parse_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = coerce.parse(messages(spark, sf_dir), list(SCHEMA)).where("_valid")
    out = df.select("offset", *coerce.project(df, SCHEMA))
    return out.select("offset", "team_id", "event", "amount", "flag", "note", F.unix_millis("timestamp").alias("ms"))


def coerce_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = coerce.parse(messages(spark, sf_dir), list(SCHEMA)).where("_valid")
    out = df.select("offset", *coerce.project(df, SCHEMA, stored=True))
    return out.select("offset", "amount", "amount32", "flag", "note", "score")


def parse_invalid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce.parse(messages(spark, sf_dir), ["event"]).groupBy("_valid").agg(F.count("*").alias("messages")).withColumnRenamed("_valid", "valid")


STAMPS = f"""CASE CAST(event_id % 6 AS INTEGER) WHEN 0 THEN concat({DAY}, 'T', {CLOCK}, 'Z') WHEN 1 THEN concat({DAY}, ' ', {CLOCK}, '.250000') WHEN 2 THEN concat({DAY}, ' ', {CLOCK}) WHEN 3 THEN concat({DAY}, 'T', {CLOCK}, '+02:00') WHEN 4 THEN {DAY} ELSE concat({DAY}, ' 10:15') END"""


def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.expr(STAMPS)
    return _events(spark, sf_dir).select("event_id", s.alias("text"), F.unix_millis(coerce.timestamp_of_text(s)).alias("ms"))


def enrich_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = enrich.enrich(messages(spark, sf_dir), {"part": "KAFKA_PARTITION", "seen_at": "kafka_time", "bad": "nowhere"})
    return df.select("_offset", "_partition", "part", F.unix_micros("_timestamp").alias("us"), F.unix_micros("seen_at").alias("seen_us"))


def enrich_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"_offset": "int64", "event": "utf8"}
    df, taken = enrich.enrich(coerce.parse(messages(spark, sf_dir), list(schema)).where("_valid"))
    return df.select(*coerce.project(df, schema, taken=taken, stored=True))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce.parse(messages(spark, sf_dir), TEMPLATE.reads()).where("_valid").withColumn("_path", route.pipeline_path(TEMPLATE))


def route_team_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("offset", F.col("_path").alias("path"))


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).groupBy(F.col("_path").alias("path")).agg(F.count("*").alias("messages"), F.min("offset").alias("first"), F.max("offset").alias("last"))


ORDER_JSON = """concat('{"o_orderstatus":"', o_orderstatus, '","o_custkey":', CAST(o_custkey AS VARCHAR(20)), CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ',"list":[1,2]' END, '}')"""


def _order_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.expr(ORDER_JSON).alias("value"))


def route_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = route.Template("s={{o_orderstatus}}/c={{o_custkey}}/l={{list}}/x={{none}}/{{a.b}}/")
    return _order_json(spark, sf_dir).select("o_orderkey", route.generic_path(t).alias("path"))


def route_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = route.Template("s={{o_orderstatus}}/l={{list}}/")
    df = _order_json(spark, sf_dir).withColumn("f", route.extract_fields(t))
    return df.select("o_orderkey", F.size("f").cast("long").alias("found"), route.path_of_map(t, "f").alias("path"))


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shred.flattened(nested(spark, sf_dir), "p", 4).select("event_id", F.explode("_leaves").alias("x"))
    return df.select("event_id", "x.key", F.col("x.depth").cast("long").alias("depth"), F.when(F.col("x.json") != "null", F.col("x.text")).alias("text"))


def _stats(spark: SparkSession, sf_dir: str, scope: list[str]) -> DataFrame:
    return shred.key_stats_of(nested(spark, sf_dir), "p", scope, 4)


def json_key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, []).select("key", "rows", "type", F.col("max_depth").cast("long").alias("max_depth"))


def json_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.plan(_stats(spark, sf_dir, []), [], 4).select("key", "placement", F.col("rank").cast("long").alias("rank"))


def json_plan_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.plan(_stats(spark, sf_dir, ["file"]), ["file"], 6).select("file", "key", "type", "placement", F.col("rank").cast("long").alias("rank"))


def _shredded(spark: SparkSession, sf_dir: str, top: int = 5) -> DataFrame:
    df = nested(spark, sf_dir).withColumn("file", F.lit(0))
    return shred.shred(df, "p", ["file"], top, 4)


def json_type_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shredded(spark, sf_dir, 9).select("event_id", F.col("_sub")["mix"].alias("mix"), F.col("_sub")["odd"].alias("odd"), F.col("_sub")["nil"].alias("nil"), F.map_contains_key("_sub", F.lit("nil")).alias("has_nil"))


def json_subcolumns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _events(spark, sf_dir).select("event_id", "props", F.lit(0).alias("file"))
    out = shred.shred(df, "props", ["file"], 10, 4)
    return out.select("event_id", F.col("_sub")["k"].alias("k"), F.col("_keys").alias("keys"))


def json_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.expr("""concat('{"a":', cast(event_id as string), ',"b":"<', event_type, '>","c":[1, {"y":1,"x":"q"}],"d":null,"e":', cast(user_id as string), '}')""")
    df = _events(spark, sf_dir).select("event_id", letters.alias("p"), F.lit(0).alias("file"))
    b = F.col("_buckets")
    return shred.shred(df, "p", ["file"], 1, 4).select("event_id", b[0].alias("b0"), b[1].alias("b1"), b[2].alias("b2"), b[3].alias("b3"))


def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shredded(spark, sf_dir).select("event_id", F.col("_keys").alias("keys"))


def json_depth_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _shredded(spark, sf_dir, 50)
    deep = F.col("_buckets")[0]
    return df.select("event_id", deep.alias("deep"), F.map_contains_key("_sub", F.lit("a.b.c.d.e.f.g")).alias("as_column"))


def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = coerce.parse(messages(spark, sf_dir), ["event", "amount", "team_id"]).where("_valid")
    df, _ = enrich.enrich(df.withColumn("_path", F.concat(F.lit("p="), F.expr("cast(partition as string)"))))
    out = layout.in_file_order(df, keys=layout.sort_keys([("event", False), ("team_id", True)]), keep=["offset"])
    return out.select("offset", F.col("_path").alias("path"), F.col("_row").alias("position"))


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = enrich.enrich(_routed(spark, sf_dir).withColumn("_path", F.regexp_extract("_path", "event=[^/]*/", 0)))
    out = layout.with_file_index(df, 300, keep=["offset"])
    return out.groupBy(F.col("_path").alias("path"), F.col("_file").cast("long").alias("file")).agg(F.count("*").alias("rows"), F.min("offset").alias("first"), F.max("offset").alias("last"))


def _config(base: str, **more) -> Config:
    schema = {"team_id": "int64", "event": "utf8", "amount": "int64", "properties": "json", "timestamp": "timestamp_ms", "_offset": "int64"}
    p = ParquetConfig(schema=schema, json_columns=[JsonColumn("properties", 8, 4)], sort_columns=[("team_id", False)], rows_per_file=2000)
    return Config(key_prefix="event={{event}}/", sinks={"out": {"type": "filesystem", "path": base}}, parquet=p, **more)


@atexit.register
def _delete_folders() -> None:
    for path, spark in _folders:
        with contextlib.suppress(Exception):  # the JVM may be gone
            system, p = hadoop_path(spark, path)
            system.delete(p, True)


_folders: list[tuple[str, SparkSession]] = []


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted when the process ends."""
    path = new_folder(spark, name)
    _folders.append((path, spark))
    return path


def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _folder(spark, "roundtrip")
    ingest.write(messages(spark, sf_dir), _config(base))
    df = table(spark, base)
    return df.select("_offset", "team_id", "event", "amount", F.unix_millis("timestamp").alias("ms"), F.col("`properties.k`").alias("k"), F.col("properties__json_keys").alias("keys"))


def write_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files whose dynamic columns differ, read together; a key found in either place."""
    base = _folder(spark, "merge")
    p = ParquetConfig(schema={"p": "json", "_offset": "int64"}, json_columns=[JsonColumn("p", 1, 4)], rows_per_file=1 << 30)
    for i, name in enumerate(("left", "right")):
        text = F.concat(F.lit('{"p":{"' + name + '":'), F.col("event_id").cast("string"), F.lit(',"z":'), F.col("user_id").cast("string"), F.lit("}}"))
        part = _events(spark, sf_dir).where(f"event_id % 2 = {i}").select(text.alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.current_timestamp().alias("timestamp"))
        ingest.write(part, Config(key_prefix=f"side={name}/", sinks={"out": {"type": "filesystem", "path": base}}, parquet=p), i)
    df = table(spark, base)
    return df.select(F.col("_offset").alias("event_id"), F.col("`p.left`").alias("left_value"), F.col("`p.right`").alias("right_value"), json_field(df, "p", "z", 4).alias("z"))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark, "stream")
    messages(spark, sf_dir).repartition(4).write.parquet(f"{root}/in")
    q = stream_ingest_plan.start(replay.stream(spark, f"{root}/in", files_per_trigger=2), _config(f"{root}/out"), f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    df = table(spark, f"{root}/out")
    return df.groupBy("event").agg(F.count("*").alias("rows"), F.sum("_offset").alias("offsets"), F.sum("team_id").alias("teams"))


def flush_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = enrich.enrich(messages(spark, sf_dir).withColumn("_path", F.concat(F.lit("p="), F.col("partition").cast("string"))))
    out = layout.flush_index(df, 100)
    return out.groupBy(F.col("_path").alias("path"), F.col("_flush").alias("flush")).agg(F.count("*").alias("events"), F.sum(F.octet_length("value") + buffer.HEADER).cast("long").alias("bytes"))


def flush_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential resets: rows of a path in order of arrival, limits on events and on bytes."""
    import pyarrow as pa

    df = messages(spark, sf_dir).select(F.concat(F.lit("p="), F.col("partition").cast("string")).alias("path"), "offset", F.octet_length("value").alias("size"))

    def run(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for path, mine in itertools.groupby(rows, lambda r: r[0]):
            at, out = [], []
            sizes = (at.append(offset) or size for _, offset, size in mine)
            for flush in buffer.flush_bytes(sizes, 200, 16_384):
                out.append((path, at.pop(), flush))
                if len(out) == 10_000:
                    yield table(out)
                    out = []
            if out:
                yield table(out)

    def table(out):
        paths, offsets, flushes = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(paths), pa.array(offsets, pa.int64()), pa.array(flushes, pa.int64())], ["path", "offset", "flush"])

    ordered = df.repartition("path").sortWithinPartitions("path", "offset")
    flushed = ordered.mapInArrow(run, "path string, offset long, flush long")
    return flushed.groupBy("path", "flush").agg(F.count("*").alias("events"), F.min("offset").alias("first"), F.max("offset").alias("last"))


def metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltlake.observe import rollup

    df = coerce.parse(messages(spark, sf_dir), ["event"]).withColumn("path", F.concat(F.lit("p="), F.col("partition").cast("string")))
    return rollup(df, "path")


def metrics_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltlake.observe import histogram

    return histogram(messages(spark, sf_dir), F.octet_length("value"), [64, 128, 160, 192, 256], ["partition"])


def value_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline: JSON texts sorted and split under a folder; how many rows each file got."""
    base = _folder(spark, "convert")
    p = ParquetConfig(schema={"event": "utf8", "team_id": "int64"}, sort_columns=[("team_id", False)], rows_per_file=700)
    done = ingest.convert(spark, messages(spark, sf_dir).select("value"), Config(parquet=p), base)
    rows = table(spark, base).agg(F.count("*").alias("rows"), F.sum("team_id").alias("teams"))
    return rows.withColumns({"files": F.lit(len(done)).cast("long"), "largest": F.lit(max(w["rows"] for w in done)).cast("long")})


QUERIES = {f.__name__: f for f in (
    parse_typed, coerce_defaults, parse_invalid_filter, timestamp_parse, enrich_metadata, enrich_clash, route_team_date, route_counts, route_generic, route_extract,
    json_flatten, json_key_stats, json_plan, json_plan_per_file, json_type_conflict, json_subcolumns, json_buckets, json_keys, json_depth_overflow,
    sort_multi, split_files, write_roundtrip, write_merge_schema, stream_ingest, flush_batches, flush_bytes, metrics_rollup, metrics_histogram, value_convert)}

M = f"WITH m AS ({MESSAGES})"
_LEAVES = """x AS (
  SELECT event_id, file, key, depth, kind, text FROM (
    SELECT event_id, CAST(event_id % 3 AS INTEGER) AS file, unnest([
      {'key': 'id', 'depth': 0, 'kind': 2, 'text': CAST(event_id AS VARCHAR)},
      {'key': 'mix', 'depth': 0, 'kind': CASE WHEN event_id % 3 = 1 THEN 4 ELSE 2 END, 'text': CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2.5' ELSE '3' END},
      {'key': CASE WHEN event_id % 4 < 3 THEN 'odd' END, 'depth': 0, 'kind': CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 8 ELSE 0 END, 'text': CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'x' END},
      {'key': CASE WHEN event_id % 5 = 0 THEN 'nil' END, 'depth': 0, 'kind': 0, 'text': NULL},
      {'key': 'user.name', 'depth': 1, 'kind': 8, 'text': event_type},
      {'key': 'user.geo.zone', 'depth': 2, 'kind': 2, 'text': CAST(user_id % 7 AS VARCHAR)},
      {'key': 'arr', 'depth': 0, 'kind': 8, 'text': '[1,2]'},
      {'key': CASE WHEN event_id % 6 = 0 THEN 'a.b.c.d.e.f.g' END, 'depth': 6, 'kind': 2, 'text': '1'},
      {'key': CASE WHEN event_id % 50 = 0 THEN 'url' END, 'depth': 0, 'kind': 8, 'text': '/p'}
    ], recursive := true) FROM events) WHERE key IS NOT NULL)"""
_TYPE = "CASE bit_or(kind) WHEN 0 THEN 'null' WHEN 1 THEN 'bool' WHEN 2 THEN 'int64' WHEN 4 THEN 'float64' WHEN 6 THEN 'float64' ELSE 'string' END"


def _plan_sql(scope: str, top: int, columns: str) -> str:
    by = f"{scope}, " if scope else ""
    over = f"PARTITION BY {scope} " if scope else ""
    return f"""WITH {_LEAVES}, s AS (SELECT {by}key, count(*) AS n, {_TYPE} AS type, max(depth) AS max_depth FROM x GROUP BY {by}key),
      r AS (SELECT {by}key, row_number() OVER ({over}ORDER BY n DESC, key) AS rank FROM s WHERE max_depth <= 5)
      SELECT {columns}, CASE WHEN r.rank <= {top} THEN 'subcolumn' ELSE 'overflow' END AS placement, CASE WHEN r.rank <= {top} THEN r.rank END AS rank
      FROM s LEFT JOIN r ON s.key = r.key {f'AND s.{scope} = r.{scope}' if scope else ''}"""


AMOUNT_OF = """CASE CAST("offset" % 6 AS INTEGER) WHEN 1 THEN 42 WHEN 5 THEN "offset" END"""
FLAG_OF = """CASE WHEN "offset" % 3 = 0 THEN true END"""
NOTE_OF = """CASE CAST("offset" % 4 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN '{"a":1}' WHEN 2 THEN '[1,2]' ELSE 'plain' END"""
PATH_OF = f"concat('team=', user_id, '/date=', replace({DAY}, '-', '/'), '/event=', event_type, '/')"

SQL = {
    "parse_typed": f"""WITH e AS (SELECT *, event_id AS "offset" FROM events WHERE {GOOD})
      SELECT "offset", user_id AS team_id, event_type AS event, {AMOUNT_OF} AS amount, {FLAG_OF} AS flag, {NOTE_OF} AS note, epoch_ms(date_trunc('second', ts)) AS ms FROM e""",
    "coerce_defaults": f"""WITH e AS (SELECT *, event_id AS "offset" FROM events WHERE {GOOD})
      SELECT "offset", coalesce({AMOUNT_OF}, 0) AS amount, 0::INTEGER AS amount32, coalesce({FLAG_OF}, false) AS flag, nullif({NOTE_OF}, '') AS note, 0::DOUBLE AS score FROM e""",
    "parse_invalid_filter": f"{M} SELECT json_valid(value) AS valid, count(*) AS messages FROM m GROUP BY 1",
    "timestamp_parse": f"""SELECT event_id, {STAMPS} AS text, CASE CAST(event_id % 6 AS INTEGER)
      WHEN 0 THEN epoch_ms(date_trunc('second', ts)) WHEN 1 THEN epoch_ms(date_trunc('second', ts)) + 250 WHEN 2 THEN epoch_ms(date_trunc('second', ts)) WHEN 3 THEN epoch_ms(date_trunc('second', ts)) - 7200000 END AS ms FROM events""",
    "enrich_metadata": f"""{M} SELECT "offset" AS _offset, CAST("partition" AS BIGINT) AS _partition, CAST("partition" AS BIGINT) AS part, epoch_us("timestamp") AS us, epoch_us("timestamp") AS seen_us FROM m""",
    "enrich_clash": f"SELECT event_id AS _offset, event_type AS event FROM events WHERE {GOOD}",
    "route_team_date": f'SELECT event_id AS "offset", {PATH_OF} AS path FROM events WHERE {GOOD}',
    "route_counts": f"SELECT {PATH_OF} AS path, count(*) AS messages, min(event_id) AS first, max(event_id) AS last FROM events WHERE {GOOD} GROUP BY 1",
    "route_generic": f"""WITH o AS (SELECT o_orderkey, {ORDER_JSON} AS value FROM orders)
      SELECT o_orderkey, concat('s=', coalesce(json_extract_string(value, '$.o_orderstatus'), ''), '/c=', coalesce(json_extract_string(value, '$.o_custkey'), ''), '/l=', coalesce(json_extract_string(value, '$.list'), ''), '/x=/{{{{a.b}}}}/') AS path FROM o""",
    "route_extract": f"""WITH o AS (SELECT o_orderkey, {ORDER_JSON} AS value FROM orders)
      SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1::BIGINT ELSE 2::BIGINT END AS found, concat('s=', coalesce(json_extract_string(value, '$.o_orderstatus'), ''), '/l=', coalesce(json_extract_string(value, '$.list'), ''), '/') AS path FROM o""",
    "json_flatten": f"WITH {_LEAVES} SELECT event_id, key, CAST(depth AS BIGINT) AS depth, text FROM x",
    "json_key_stats": f"WITH {_LEAVES} SELECT key, count(*) AS rows, {_TYPE} AS type, CAST(max(depth) AS BIGINT) AS max_depth FROM x GROUP BY key",
    "json_plan": _plan_sql("", 4, "s.key"),
    "json_plan_per_file": _plan_sql("file", 6, "s.file, s.key, s.type"),
    "json_type_conflict": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2.5' ELSE '3' END AS mix,
      CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'x' END AS odd, CAST(NULL AS VARCHAR) AS nil, event_id % 5 = 0 AS has_nil FROM events""",
    "json_subcolumns": "SELECT event_id, json_extract_string(props, '$.k') AS k, '[\"k\"]' AS keys FROM events",
    "json_buckets": """SELECT event_id, concat('{"e":', user_id, '}') AS b0, CAST(NULL AS VARCHAR) AS b1, concat('{"b":"\\u003c', event_type, '\\u003e","d":null}') AS b2, '{"c":"[1,{\\"x\\":\\"q\\",\\"y\\":1}]"}' AS b3 FROM events""",
    "json_keys": f"""WITH {_LEAVES} SELECT event_id, concat('["', array_to_string(list(key ORDER BY key), '","'), '"]') AS keys FROM x GROUP BY event_id""",
    "json_depth_overflow": """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN '{"a.b.c.d.e.f.g":1}' END AS deep, false AS as_column FROM events""",
    "sort_multi": f"""SELECT event_id AS "offset", concat('p=', event_id % 4) AS path, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_type, user_id DESC, event_id) - 1 AS position FROM events WHERE {GOOD}""",
    "split_files": f"""WITH r AS (SELECT event_id, concat('event=', event_type, '/') AS path, row_number() OVER (PARTITION BY event_type ORDER BY event_id % 4, event_id) - 1 AS n FROM events WHERE {GOOD})
      SELECT path, CAST(n // 300 AS BIGINT) AS file, count(*) AS rows, min(event_id) AS first, max(event_id) AS last FROM r GROUP BY 1, 2""",
    "write_roundtrip": f"""WITH e AS (SELECT *, event_id AS "offset" FROM events WHERE {GOOD})
      SELECT event_id AS _offset, user_id AS team_id, event_type AS event, coalesce({AMOUNT_OF}, 0) AS amount, epoch_ms(date_trunc('second', ts)) AS ms, json_extract_string(props, '$.k') AS k, '["k"]' AS keys FROM e""",
    "write_merge_schema": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS left_value, CASE WHEN event_id % 2 = 1 THEN CAST(event_id AS VARCHAR) END AS right_value, CAST(user_id AS VARCHAR) AS z FROM events""",
    "stream_ingest": f"SELECT event_type AS event, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS offsets, CAST(sum(user_id) AS BIGINT) AS teams FROM events WHERE {GOOD} GROUP BY 1",
    "flush_batches": f"""{M}, r AS (SELECT value, concat('p=', "partition") AS path, (row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1) // 100 AS flush FROM m)
      SELECT path, CAST(flush AS BIGINT) AS flush, count(*) AS events, CAST(sum(strlen(value) + 4) AS BIGINT) AS bytes FROM r GROUP BY 1, 2""",
    "flush_bytes": f"""WITH RECURSIVE m AS ({MESSAGES}),
      r AS MATERIALIZED (SELECT "partition" AS p, "offset" AS o, strlen(value) + 4 AS n, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS i FROM m),
      w AS (SELECT p, o, i, 0::BIGINT AS flush, 1::BIGINT AS events, n AS held FROM r WHERE i = 1
        UNION ALL SELECT r.p, r.o, r.i, CASE WHEN events >= 200 OR held >= 16384 THEN flush + 1 ELSE flush END,
          CASE WHEN events >= 200 OR held >= 16384 THEN 1 ELSE events + 1 END, CASE WHEN events >= 200 OR held >= 16384 THEN r.n ELSE held + r.n END
        FROM w JOIN r ON r.p = w.p AND r.i = w.i + 1)
      SELECT concat('p=', p) AS path, flush, count(*) AS events, min(o) AS first, max(o) AS last FROM w GROUP BY 1, 2""",
    "metrics_rollup": f"""{M} SELECT concat('p=', "partition") AS path, count(*) AS received, CAST(sum(strlen(value)) AS BIGINT) AS bytes_in,
      CAST(sum(CASE WHEN json_valid(value) THEN 1 ELSE 0 END) AS BIGINT) AS processed, CAST(sum(CASE WHEN json_valid(value) THEN 0 ELSE 1 END) AS BIGINT) AS parse_errors FROM m GROUP BY 1""",
    "metrics_histogram": f"""{M} SELECT "partition", bound, count(*) FILTER (bound IS NULL OR strlen(value) <= bound) AS observations
      FROM m CROSS JOIN (VALUES (64.0::DOUBLE), (128), (160), (192), (256), (NULL)) AS b(bound) GROUP BY 1, 2""",
    "value_convert": f"SELECT count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS teams, CAST(ceil(count(*) / 700.0) AS BIGINT) AS files, least(count(*), 700) AS largest FROM events WHERE {GOOD}",
}
