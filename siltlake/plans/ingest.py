"""The logical plan from envelopes to rows ready to write; and batch and offline entry points."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.config import Config
from siltlake.functions import coerce
from siltlake.functions.shared import scratch
from siltlake.operators import layout
from siltlake.operators.enrich import enrich
from siltlake.operators.route import Template, pipeline_path
from siltlake.sinks import files


def rows(envelope: DataFrame, config: Config, now: datetime | None = None) -> tuple[DataFrame, list[str]]:
    """Rows with _path, _file, _row and the declared columns, and the columns' names. now: what counts as the present,
    so that a batch which runs again gives the same rows."""
    template, p = Template(config.key_prefix), config.parquet
    clock = F.current_timestamp() if now is None else F.lit(now)
    wanted = [*p.schema, *template.reads(), *(c.split(".")[0] for c, _ in p.sort_columns)]
    df = coerce.parse(envelope, list(dict.fromkeys(wanted))).where("_valid").withColumn("_path", pipeline_path(template, now=clock))
    df, taken = enrich(df, config.dynamic_columns, clock)
    declared = sorted(p.schema)
    # nothing but declared columns, by number, and sort keys goes on
    named = {f"_d{i}": c for i, c in enumerate(coerce.project(df, p.schema, taken=taken, stored=True))}
    keys = {f"_k{i}": c for i, c in enumerate(layout.key_columns(p.sort_columns))}
    ties = [t for t in layout.TIES if t in df.columns]
    df = df.select("_path", *ties, *(c.alias(n) for n, c in (named | keys).items()))
    directions = [d for _, d in p.sort_columns for _ in range(2)]
    order = [F.col(n).desc() if d else F.col(n).asc() for n, d in zip(keys, directions)]
    out = layout.with_file_index(df, p.rows_per_file, keys=order, keep=list(named))
    return out.select("_path", "_file", "_row", *(F.col(n).alias(c) for n, c in zip(named, declared))), declared


def write(envelope: DataFrame, config: Config, batch: int = 0, now: datetime | None = None) -> list[dict]:
    """Write a batch of envelopes to the configured sink. A dict for each file: path, name, rows, bytes."""
    with scratch():
        df, declared = rows(envelope, config, now)
        return files.write_batch(df, files.sink_of(config.sink(), config.key_prefix), batch, config.parquet, declared)


def convert(spark: SparkSession, values: DataFrame, config: Config, base: str) -> list[dict]:
    """Offline: a column `value` of JSON texts, sorted and split under base."""
    envelope = values.select("value", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))
    with scratch():
        df, declared = rows(envelope, config)
        return files.write_batch(df, files.FileSink(base), 0, config.parquet, declared)
