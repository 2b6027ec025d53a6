"""Metadata columns of the message envelope, added as columns and never written back into the text."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

SOURCES = ("kafka_time", "current_time", "kafka_offset", "kafka_partition")
DEFAULTS = {"_timestamp": "kafka_time", "_offset": "kafka_offset", "_partition": "kafka_partition"}


def dynamic_columns(configured: dict[str, str] | None) -> dict[str, str]:
    """Column -> source: the three defaults, which may be overridden, then the others by name. Sources
    are read in any case; unknown ones are skipped with a warning."""
    wanted = {}
    for name, source in (configured or {}).items():
        if source.lower() in SOURCES:
            wanted[name] = source.lower()
        else:
            log.warning("dynamic column %s: unknown source %s", name, source)
    return {n: wanted.get(n, s) for n, s in DEFAULTS.items()} | {n: wanted[n] for n in sorted(wanted) if n not in DEFAULTS}


def source_column(source: str, now: Column | None = None) -> Column:
    return {
        "kafka_time": F.col("timestamp"),
        "current_time": F.current_timestamp() if now is None else now,
        "kafka_offset": F.col("offset").cast("bigint"),
        "kafka_partition": F.col("partition").cast("bigint"),
    }[source]


def enrich(envelope: DataFrame, configured: dict[str, str] | None = None, now: Column | None = None) -> tuple[DataFrame, tuple[str, ...]]:
    """The envelope with its metadata columns, and their names: they win over payload fields of the
    same name. current_time is `now`, else one time per query or micro-batch."""
    columns = dynamic_columns(configured)
    return envelope.withColumns({n: source_column(s, now) for n, s in columns.items()}), tuple(columns)
