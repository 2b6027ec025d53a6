"""JSON shredding: flatten, infer, rank, split into subcolumns and buckets.

Pass one aggregates the leaves of each scope (an output file, or a whole batch) to a plan: per key the
rows that have it, the join of its kinds and its greatest depth. The kinds' join is a bit_or, so it
combines map-side in any order. Keys deeper than max_depth go to buckets; of the others the most
frequent become subcolumns, ties by key.

Pass two needs no second grouping of leaves: a scope's plan, at most max_subcolumns entries, meets
its rows as one map, and each row is expanded where it stands by array functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltlake.functions import jsonflat
from siltlake.functions.jsonflat import BOOL, FLOAT, INT, NULL, STRING


def joined_type(bits: Column) -> Column:
    """The lattice join: null is neutral, int and float make float, any other mix is a string."""
    return (
        F.when(bits == NULL, "null").when(bits == BOOL, "bool").when(bits == INT, "int64")
        .when(bits.isin(FLOAT, INT | FLOAT), "float64").otherwise("string")
    )


def flattened(df: DataFrame, column: str, buckets: int = 256, into: str = "_leaves") -> DataFrame:
    return df.withColumn(into, jsonflat.flat(F.col(column), buckets))


def key_stats(df: DataFrame, scope: list[str], leaves: str = "_leaves") -> DataFrame:
    """scope, key, rows, kinds, type, max_depth, bucket."""
    rows = df.select(*scope, F.explode(leaves).alias("leaf")).select(*scope, "leaf.key", "leaf.kind", "leaf.depth", "leaf.bucket")
    stats = rows.groupBy(*scope, "key").agg(F.count("*").alias("rows"), F.bit_or("kind").alias("kinds"), F.max("depth").alias("max_depth"), F.min("bucket").alias("bucket"))
    return stats.withColumn("type", joined_type(F.col("kinds")))


def key_stats_of(df: DataFrame, column: str, scope: list[str], buckets: int = 256) -> DataFrame:
    """key_stats of a column of JSON texts, counted where the texts are parsed; no leaf leaves its task."""
    texts = df.select(*scope, F.col(f"`{column}`").cast("string").alias("_text"))
    kinds = StructType([*(texts.schema[c] for c in scope), *StructType.fromDDL("key string, rows long, kinds int, max_depth int, bucket int").fields])
    parts = texts.mapInArrow(lambda it: jsonflat.counted_keys(it, buckets), kinds)
    stats = parts.groupBy(*scope, "key").agg(F.sum("rows").alias("rows"), F.bit_or("kinds").alias("kinds"), F.max("max_depth").alias("max_depth"), F.min("bucket").alias("bucket"))
    return stats.withColumn("type", joined_type(F.col("kinds")))


def plan(stats: DataFrame, scope: list[str], max_subcolumns: int = 1024, max_depth: int = 5) -> DataFrame:
    """The statistics with `placement`: subcolumn or overflow, and `rank` of the subcolumns."""
    shallow = F.col("max_depth") <= max_depth
    w = Window.partitionBy(*scope, shallow).orderBy(F.desc("rows"), "key")
    rank = F.row_number().over(w)
    out = stats.withColumn("rank", F.when(shallow & (rank <= max_subcolumns), rank))
    return out.withColumn("placement", F.when(F.col("rank").isNull(), "overflow").otherwise("subcolumn"))


def plan_maps(stats: DataFrame, scope: list[str], max_subcolumns: int = 1024, max_depth: int = 5) -> DataFrame:
    """scope and `_plan`: a map from each subcolumn's key to its type, at most max_subcolumns entries."""
    w = Window.partitionBy(*scope).orderBy(F.desc("rows"), "key")
    top = stats.where(F.col("max_depth") <= max_depth).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_subcolumns)
    return top.groupBy(*scope).agg(F.map_from_entries(F.collect_list(F.struct("key", "type"))).alias("_plan"))


def rendered(leaf: Column, type_name: Column) -> Column:
    """A leaf's text in a subcolumn of the given type; null where the type doesn't take it."""
    kind = leaf["kind"]
    value = (
        F.when(type_name == "bool", F.when(kind == BOOL, leaf["text"]))
        .when(type_name == "int64", F.when(kind == INT, leaf["text"]))
        .when(type_name == "float64", leaf["shown"])
        .when(type_name == "string", F.when(leaf["json"] != "null", leaf["text"]))
    )
    return F.when(value != "", value)


def json_object(leaves: Column) -> Column:
    """JSON object text of leaves, which are in order of key."""
    return F.concat(F.lit("{"), F.array_join(F.transform(leaves, lambda x: F.concat(x["jkey"], F.lit(":"), x["json"])), ","), F.lit("}"))


def keys_text(leaves: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(leaves, lambda x: x["jkey"]), ","), F.lit("]"))


def expand(df: DataFrame, leaves: str = "_leaves", plan_column: str = "_plan", max_depth: int = 5) -> DataFrame:
    """Adds _sub map<key, text>, _buckets map<number, JSON text> and _keys; all null where the text is
    no object."""
    x, p = F.col(leaves), F.coalesce(F.col(plan_column), F.create_map().cast("map<string,string>"))
    planned = lambda leaf: (leaf["depth"] <= max_depth) & F.map_contains_key(p, leaf["key"])
    sub = F.map_from_entries(F.transform(F.filter(x, planned), lambda leaf: F.struct(leaf["key"], rendered(leaf, F.element_at(p, leaf["key"])))))
    rest = F.filter(x, lambda leaf: ~planned(leaf))
    numbers = F.array_sort(F.array_distinct(F.transform(rest, lambda leaf: leaf["bucket"])))
    buckets = F.map_from_entries(F.transform(numbers, lambda b: F.struct(b, json_object(F.filter(rest, lambda leaf: leaf["bucket"] == b)))))
    return df.withColumns({"_sub": sub, "_buckets": buckets, "_keys": keys_text(x)})


def shred(df: DataFrame, column: str, scope: list[str], max_subcolumns: int = 1024, buckets: int = 256, max_depth: int = 5) -> DataFrame:
    """df with _sub, _buckets and _keys. Texts are parsed once for the plan and once for the rows; the
    plans are small beside the rows, and Spark broadcasts them where their size allows it."""
    maps = plan_maps(key_stats_of(df, column, scope, buckets), scope, max_subcolumns, max_depth)
    rows = flattened(df, column, buckets)
    return expand(rows.join(maps, scope, "left"), max_depth=max_depth).drop("_leaves", "_plan")


def subcolumn_names(column: str, stats_plan: DataFrame) -> list[str]:
    """Names of one scope's subcolumns, at most max_subcolumns of them."""
    return sorted(f"{column}.{r['key']}" for r in stats_plan.where("placement = 'subcolumn'").select("key").distinct().collect())


def bucket_column(column: str, number: int) -> str:
    return f"{column}__json_type_bucket_{number}"


def keys_column(column: str) -> str:
    return f"{column}__json_keys"
