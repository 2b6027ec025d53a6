"""Parquet files of bounded rows under template paths.

Rows come with _path and _file. Each file is written by one task from its own rows, at most
rows_per_file of them: the task shreds their JSON columns by the plan of just these rows, writes the file
beside its target and publishes it. Names are derived from (batch, path, file), so a batch that runs again
replaces its own files and adds none, and an attempt that fails leaves no torn file. The driver gets a
short row for each file.

A sink says where files go and how they get there: anything with `publish`. Executors reach it through
pyarrow's file system of its scheme.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections import defaultdict
from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.config import ConfigError, JsonColumn, ParquetConfig
from siltlake.functions import jsonflat
from siltlake.functions.jsonflat import BOOL, FLOAT, INT, NULL
from siltlake.operators.shred import bucket_column, keys_column

STAGES = ("sort", "json", "write", "publish")  # of a file: rows in order, shredding, Parquet, the rest of the sink's work
WRITTEN = "path string, name string, rows long, bytes long, wall array<double>, cpu array<double>"


class Sink(Protocol):
    """What a custom sink must do; it is sent to executors."""

    def publish(self, path: str, name: str, write: Callable) -> int:
        """Have `write` write a file to an open binary stream, make it visible as path/name at once and whole, in place
        of a file that has the name, and return its size."""


class FileSink:
    """Files under `base`, a URI or a folder."""

    def __init__(self, base: str):
        self.base = base

    def publish(self, path: str, name: str, write: Callable) -> int:
        system, root = _opened(self.base)
        target = "/".join(x for x in (root.rstrip("/"), path.strip("/")) if x)
        if system.type_name in ("s3", "gcs", "abfs"):  # an object is there when it is whole
            at = f"{target}/{name}"
        else:  # readers pass over names that start so; a second attempt has its own
            at = f"{target}/_{name}.{uuid.uuid4().hex}"
            system.create_dir(target, recursive=True)
        try:
            with system.open_output_stream(at) as out:
                write(out)
            size = system.get_file_info(at).size
            if at != f"{target}/{name}":
                system.move(at, f"{target}/{name}")
        except BaseException:
            if at != f"{target}/{name}" and system.get_file_info(at).is_file:
                system.delete_file(at)
            raise
        return size


def codec(name: str, level: int) -> tuple[str, int | None]:
    """Codec and level; unknown names mean zstd."""
    name = (name or "none").lower()
    if name in ("none", "uncompressed"):
        return "none", None
    if name == "snappy":
        return "snappy", None
    if name == "gzip":
        return "gzip", min(9, max(1, level))
    return "zstd", level or 5


def spark_options(p: ParquetConfig) -> dict[str, str]:
    """The same tuning as options of Spark's own Parquet writer, for Hive-like layouts."""
    kind, level = codec(p.compression, p.compression_level)
    out = {"compression": kind, "maxRecordsPerFile": str(p.rows_per_file), "parquet.block.row.count.limit": str(p.max_rows_per_row_group), "parquet.page.size": str(p.page_buffer_bytes)}
    if kind == "zstd":
        out["parquet.compression.codec.zstd.level"] = str(level)
    if kind == "gzip":
        out["zlib.compress.level"] = str(level)
    for c in p.no_bounds:
        out[f"parquet.column.statistics.enabled#{c}"] = "false"
    for c in p.bloom_filters:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
    return out


def file_name(batch: int, path: str, file: int) -> str:
    """Sorts by batch and file; the same for the same rows."""
    return f"{batch:010d}-{file:08d}-{hashlib.sha256(path.encode()).hexdigest()[:12]}.parquet"


def _joined(kinds: int) -> str:
    """The name of the type that the kinds' bits join to."""
    return {NULL: "null", BOOL: "bool", INT: "int64", FLOAT: "float64", INT | FLOAT: "float64"}.get(kinds, "string")


def shredded(texts: list[str | None], column: JsonColumn) -> dict[str, pa.Array]:
    """The subcolumns of these texts' plan, every bucket and the keys column. What shred.plan_maps and shred.expand
    give for a scope of these rows, made in one pass over their leaves."""
    n, rows, kinds, depths = len(texts), defaultdict(int), defaultdict(int), defaultdict(int)
    found = [jsonflat.flatten(t, column.bucket_count) for t in texts]
    for leaves in found:
        for key, _, _, kind, depth, *_ in leaves or ():
            rows[key] += 1
            kinds[key] |= kind
            depths[key] = max(depths[key], depth)
    ranked = sorted((k for k in rows if depths[k] <= column.max_depth), key=lambda k: (-rows[k], k.encode("utf-8", "surrogatepass")))[: column.max_subcolumns]
    types = {k: _joined(kinds[k]) for k in ranked}
    sub, rest, keys = {k: ([], []) for k in ranked}, defaultdict(lambda: ([], [])), []
    for i, leaves in enumerate(found):
        full = defaultdict(list)
        for key, jkey, bucket, kind, depth, text, form, shown in leaves or ():
            if key not in types:
                full[bucket].append(f"{jkey}:{form}")
                continue
            as_type = types[key]
            value = shown if as_type == "float64" else text if as_type == "string" and form != "null" or as_type == "bool" and kind == BOOL or as_type == "int64" and kind == INT else None
            if value:
                sub[key][0].append(i)
                sub[key][1].append(value)
        for bucket, parts in full.items():
            rest[bucket][0].append(i)
            rest[bucket][1].append("{" + ",".join(parts) + "}")
        keys.append(None if leaves is None else "[" + ",".join(x[1] for x in leaves) + "]")

    def spread(at: list[int], values: list[str]) -> pa.Array:
        place = np.full(n, -1)
        place[at] = np.arange(len(at))
        return pa.array(values, pa.string()).take(pa.array(place, mask=place < 0))

    out = {f"{column.name}.{k}": spread(*sub[k]) for k in ranked}
    out |= {bucket_column(column.name, b): spread(*rest[b]) if b in rest else pa.nulls(n, pa.string()) for b in range(column.bucket_count)}
    out[keys_column(column.name)] = pa.array(keys, pa.string())
    return out


def dynamic_table(rows: pa.Table, columns: list[JsonColumn], declared: list[str]) -> pa.Table:
    """Declared columns and what each JSON column is shredded to, in order of name. A JSON column that isn't declared
    gives no values."""
    out = {n: rows.column(n) for n in declared}
    for column in columns:
        texts = rows.column(column.name).to_pylist() if column.name in declared else [None] * rows.num_rows
        for name, values in shredded(texts, column).items():
            if name in out:
                raise ConfigError(f"subcolumn {name} has the name of another column")
            out[name] = values
    return pa.table({n: out[n] for n in sorted(out, key=str.encode)})


def _opened(base: str):
    from pyarrow import fs

    if base.startswith("s3a://"):  # Hadoop's name for the scheme
        base = "s3" + base.removeprefix("s3a")
    return fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), base)


def write_batch(df: DataFrame, sink: Sink | str, batch: int, p: ParquetConfig, declared: list[str]) -> list[dict]:
    """Write the rows (declared columns, _path, _file, _row). Returns a dict for each file: path, name, rows, bytes,
    and the seconds that each of STAGES took, by the clock (wall) and of the task's thread (cpu)."""
    columns, sink = p.json_columns, FileSink(sink) if isinstance(sink, str) else sink
    kind, level = codec(p.compression, p.compression_level)
    bounded = [n for n in declared if n not in p.no_bounds]
    # dotted names would be taken for paths; the tasks get their columns by number
    named = {f"_d{i}": n for i, n in enumerate(declared)}

    def write(key: tuple, rows: pa.Table) -> pa.Table:
        path, file = key[0].as_py(), key[1].as_py()
        clocks = lambda: np.array([time.perf_counter(), time.thread_time()])
        began = clocks()
        rows = rows.sort_by("_row")
        in_order = clocks()
        table = dynamic_table(rows.rename_columns([named.get(n, n) for n in rows.column_names]), columns, declared)
        stats = [n for n in table.column_names if n in bounded or any(n.startswith(f"{c.name}.") for c in columns)]
        name = file_name(batch, path, file)
        spent = np.zeros(2)

        def to(out) -> None:
            nonlocal spent
            before = clocks()
            pq.write_table(table, out, compression=kind, compression_level=level, row_group_size=p.max_rows_per_row_group, data_page_size=p.page_buffer_bytes, write_statistics=stats or False, use_dictionary=True)
            spent = clocks() - before

        made = clocks()
        size = sink.publish(path, name, to)
        wall, cpu = np.stack([in_order - began, made - in_order, spent, clocks() - made - spent], axis=1).tolist()
        return pa.table({
            "path": [path], "name": [name], "rows": pa.array([rows.num_rows], pa.int64()), "bytes": pa.array([size], pa.int64()),
            "wall": pa.array([wall], pa.list_(pa.float64())), "cpu": pa.array([cpu], pa.list_(pa.float64()))})

    numbered = df.select("_path", "_file", "_row", *(F.col("`" + n.replace("`", "``") + "`").alias(d) for d, n in named.items()))
    return [r.asDict() for r in numbered.groupBy("_path", "_file").applyInArrow(write, WRITTEN).collect()]  # one row a file


#: Kinds of sinks: configuration and key prefix -> sink. Others may be entered.
SINKS: dict[str, Callable[[dict, str], Sink]] = {
    "aws_s3": lambda config, _: FileSink(f"s3a://{config['bucket']}/{(config.get('prefix') or '').strip('/')}".rstrip("/")),
    "filesystem": lambda config, key_prefix: FileSink(config.get("path") or key_prefix),
}


def sink_of(config: dict, key_prefix: str = "") -> Sink:
    """aws_s3: s3a://bucket/prefix; filesystem: its path, else the key prefix."""
    kind = config.get("type")
    if kind not in SINKS:
        raise ConfigError(f"unsupported sink type {kind}")
    return SINKS[kind](config, key_prefix)
