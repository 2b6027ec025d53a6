"""Sort keys, row numbers within paths, and the split into files.

Numbering must not gather a path in one task: rows are range-partitioned by (path, sort keys), so a
large path spans partitions, and sorted there. Each row takes along its place in its partition, and the
sorted rows are written once. The rows of the same path in earlier partitions, one number for each
partition and path, then make the place a number within the path: no window over rows, and no second
exchange of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltlake.functions.coerce import kind_of, text_of
from siltlake.functions.shared import materialise

TIES = ["_partition", "_offset"]


def key_columns(columns: list[tuple[str, bool]], fields: str = "_fields") -> list[Column]:
    """Two columns for each sort column: the number, infinite for a text, null if missing; and the text."""
    out = []
    for name, _ in columns:
        head, *path = name.split(".")
        v = F.col(f"{fields}.`{head}`")
        if path:
            v = F.try_variant_get(v, "$" + "".join(f"['{p}']" for p in path), "variant")
        kind = kind_of(v)
        number = F.when(kind == "number", F.try_variant_get(v, "$", "double"))
        text = F.when(kind.isin("string", "bool", "array", "object"), text_of(v))
        out += [F.when(number.isNull() & text.isNull(), None).otherwise(F.coalesce(number, F.lit(float("inf")))), text]
    return out


def sort_keys(columns: list[tuple[str, bool]], fields: str = "_fields") -> list[Column]:
    """Order by raw payload values: null and missing first when ascending, last when descending.
    Numbers compare as doubles, texts by bytes, false before true. Comparing values of different kinds
    by their text, pair by pair, gives no order at all (2 < 10 < "1a" < 2); here numbers come before
    texts, which makes one."""
    keys = key_columns(columns, fields)
    return [k.desc() if columns[i // 2][1] else k.asc() for i, k in enumerate(keys)]


def in_file_order(df: DataFrame, path: str = "_path", keys: list | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (else all) and _row: the row's number within its path, from 0, by keys and then the
    message's place."""
    order = [F.col(path), *(keys or []), *(F.col(t).asc() for t in TIES if t in df.columns)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = list(dict.fromkeys([path, *(keep if keep is not None else df.columns)]))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialise(ranged.select(*(F.col(f"`{c}`") for c in kept), F.monotonically_increasing_id().alias("_place")), "in-order")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))  # the id's upper half is the partition
    counts = placed.groupBy(path, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy(path).orderBy("_part")) - F.col("_n")
    before = counts.select(F.col(path).alias("_of"), F.col("_part").alias("_in"), (earlier - F.col("_first")).alias("_shift"))
    joined = placed.join(before, placed[path].eqNullSafe(before["_of"]) & (placed["_part"] == before["_in"]))
    return joined.withColumn("_row", F.col("_place") + F.col("_shift")).drop("_part", "_place", "_of", "_in", "_shift")


def with_file_index(df: DataFrame, rows_per_file: int, path: str = "_path", keys: list | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds _row and _file: files of rows_per_file rows, the last one short; file order is sort order."""
    return in_file_order(df, path, keys, keep).withColumn("_file", F.floor(F.col("_row") / rows_per_file).cast("int"))


def flush_index(df: DataFrame, max_events: int, path: str = "_path") -> DataFrame:
    """Adds _flush: which count-triggered flush of its path a message falls into, in order of arrival."""
    return in_file_order(df, path).withColumn("_flush", F.floor(F.col("_row") / max_events).cast("long")).drop("_row")
