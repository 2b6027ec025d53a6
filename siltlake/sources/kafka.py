"""Kafka as a stream of envelopes. The connector is a separate jar, which the cluster provides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltlake.config import bootstrap_servers

ENVELOPE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def options(source: dict, max_offsets: int | None = None) -> dict[str, str]:
    """Reader options of a configured source: all its topics in one subscription; `earliest` starts at
    the oldest offset, any other reset at the newest; TLS without client certificates on request. Offsets
    that the broker no longer has stop the stream unless fail_on_data_loss is false. Flow control is a
    bound on the offsets of a micro-batch."""
    out = {
        "kafka.bootstrap.servers": ",".join(bootstrap_servers(source.get("bootstrap_servers", ""))),
        "subscribe": ",".join(source.get("topics") or []),
        "startingOffsets": "earliest" if source.get("auto_offset_reset") == "earliest" else "latest",
        "kafka.fetch.max.bytes": str(max(source.get("fetch_max_bytes") or 2 << 20, source.get("fetch_default_bytes") or 256 << 10)),
        "failOnDataLoss": str(source.get("fail_on_data_loss", True)).lower(),
    }
    if source.get("group_id"):
        out["kafka.group.id"] = source["group_id"]
    if (source.get("tls") or {}).get("enabled"):
        out |= {"kafka.security.protocol": "SSL", "kafka.ssl.enabled.protocols": "TLSv1.2,TLSv1.3"}
    if max_offsets:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    return out


def stream(spark: SparkSession, source: dict, max_offsets: int | None = None) -> DataFrame:
    df = spark.readStream.format("kafka").options(**options(source, max_offsets)).load()
    return df.selectExpr("cast(value as string) as value", "partition", "offset", "timestamp")
