"""Configuration: YAML in, dataclasses with defaults out."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

GIB = 1 << 30


class ConfigError(ValueError):
    pass


@dataclass
class BufferConfig:
    max_events: int = 100_000
    max_bytes: int = 10 * GIB
    timeout_secs: float = 60
    timeout_splay_secs: float = 0
    max_pending_flushes: int = 100
    max_concurrent_flushes: int = 4
    max_total_bytes: int = 50 * GIB
    high_watermark_bytes: int = 0  # 0: 80 % of max_total_bytes
    low_watermark_bytes: int = 0  # 0: 60 %

    def __post_init__(self):
        self.high_watermark_bytes = self.high_watermark_bytes or self.max_total_bytes * 80 // 100
        self.low_watermark_bytes = self.low_watermark_bytes or self.max_total_bytes * 60 // 100
        if self.low_watermark_bytes >= self.high_watermark_bytes:
            self.low_watermark_bytes = self.high_watermark_bytes * 60 // 100


@dataclass
class JsonColumn:
    name: str
    max_subcolumns: int = 1024
    bucket_count: int = 256
    max_depth: int = 5


@dataclass
class ParquetConfig:
    schema: dict[str, str] = field(default_factory=dict)
    json_columns: list[JsonColumn] = field(default_factory=list)
    sort_columns: list[tuple[str, bool]] = field(default_factory=list)  # (name, descending)
    rows_per_file: int = 10_000
    max_rows_per_row_group: int = 1_000
    page_buffer_bytes: int = 65_536
    compression: str = "zstd"
    compression_level: int = 5
    no_bounds: list[str] = field(default_factory=list)  # columns without min/max statistics
    bloom_filters: list[str] = field(default_factory=list)


@dataclass
class Config:
    data_dir: str = "/data/"
    metrics_port: int = 8075
    key_prefix: str = ""
    dynamic_columns: dict[str, str] = field(default_factory=dict)
    sources: dict[str, dict] = field(default_factory=dict)
    sinks: dict[str, dict] = field(default_factory=dict)
    buffer: BufferConfig = field(default_factory=BufferConfig)
    parquet: ParquetConfig = field(default_factory=ParquetConfig)

    def source(self) -> dict:
        """The first Kafka source by name."""
        return _first(self.sources, "kafka")

    def sink(self) -> dict:
        """The first object-store sink by name, else the first file-system one."""
        for kind in ("aws_s3", "filesystem"):
            if any(s.get("type") == kind for s in self.sinks.values()):
                return _first(self.sinks, kind)
        raise ConfigError("no sink of type aws_s3 or filesystem")


def _first(named: dict[str, dict], kind: str) -> dict:
    for name in sorted(named):
        if named[name].get("type") == kind:
            return {"name": name} | named[name]
    raise ConfigError(f"no entry of type {kind}")


def bootstrap_servers(text: str) -> list[str]:
    """Broker addresses, separated by commas or line feeds."""
    found = [x.strip() for x in re.split(r"[,\n]", text or "") if x.strip()]
    if not found:
        raise ConfigError("no bootstrap servers")
    return found


def _pick(kind, given: dict):
    return kind(**{k: v for k, v in (given or {}).items() if k in kind.__dataclass_fields__ and v not in (None, 0, "")})


def _fields(given) -> tuple[dict[str, str], list[str], list[str]]:
    """Types of a schema's fields, those without statistics, those with a Bloom filter."""
    fields = {n: (t if isinstance(t, dict) else {"type": t}) for n, t in (given or {}).items()}
    return {n: t.get("type") or "utf8" for n, t in fields.items()}, [n for n, t in fields.items() if t.get("minmax_index") is False], [n for n, t in fields.items() if t.get("bloom_filter")]


def _json_columns(given) -> list[JsonColumn]:
    """A list of entries with `column` (or `name`), or a mapping from names."""
    entries = given.items() if isinstance(given, dict) else ((c.get("column") or c.get("name"), c) for c in given or [])
    out = [_pick(JsonColumn, {**(c or {}), "name": n}) for n, c in sorted(entries)]
    for c in out:
        c.max_depth = 5  # the depth that takes effect is fixed
    return out


def from_dict(raw: dict) -> Config:
    """Settings of the sink that is in use (see Config.sink), which may also stand at the top. Keys that the engine
    doesn't know are ignored; zeros and empty values mean the default."""
    raw = raw or {}
    out = _pick(Config, {k: v for k, v in raw.items() if k not in ("buffer", "parquet")})
    try:
        sink = out.sink()
    except ConfigError:
        sink = next((raw["sinks"][n] for n in sorted(raw.get("sinks") or {})), {})
    encoding = {**(raw.get("parquet") or {}), **(sink.get("encoding") or {}), **((sink.get("encoding") or {}).get("parquet") or {})}
    batching = {**(raw.get("buffer") or {}), **(sink.get("buffer") or {}), **(sink.get("disk_batching") or {})}
    out.buffer = _pick(BufferConfig, {**batching, **(batching.get("backpressure") or {})})
    out.key_prefix = raw.get("key_prefix") or sink.get("key_prefix") or ""
    out.dynamic_columns = {**(raw.get("dynamic_columns") or {}), **(encoding.get("dynamic_columns") or {})}
    schema, no_bounds, blooms = _fields(encoding.get("schema"))
    order = [(c, False) if isinstance(c, str) else (c.get("column") or c.get("name"), bool(c.get("descending") or c.get("order") == "desc")) for c in encoding.get("sorting_columns") or encoding.get("sort_columns") or []]
    out.parquet = _pick(ParquetConfig, {k: v for k, v in encoding.items() if k not in ("schema", "json_columns", "sort_columns")})
    out.parquet.schema, out.parquet.json_columns, out.parquet.sort_columns = schema, _json_columns(encoding.get("json_columns")), order
    out.parquet.no_bounds = no_bounds + [c for c in out.parquet.no_bounds if c not in no_bounds]
    out.parquet.bloom_filters = blooms + [c for c in out.parquet.bloom_filters if c not in blooms]
    return out


def load(path: str) -> Config:
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f))
