"""Declared types: JSON values to columns, and the defaults that a file stores for nulls.

Messages are parsed once, into one variant per declared field. A variant keeps the JSON kind, so a
number in a text field, or a text in a number field, is told apart; what a type doesn't accept is
null. Number literals within text fields are normalised (2.50 reads 2.5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT, INT64, INT32 = ("utf8", "string", "json"), ("int64",), ("int32",)
DOUBLE, FLOAT, BOOL = ("float64", "double"), ("float32", "float"), ("bool", "boolean")
TIMES = ("timestamp_ms", "timestamp_us")

#: Date and time, with T and an optional zone or with a space and none; seconds are needed.
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}([.]\d+)?(Z|[+-]\d{2}:\d{2})?| \d{2}:\d{2}:\d{2}([.]\d+)?)$"


def spark_type(name: str) -> str:
    for names, kind in ((TEXT, "string"), (INT64, "bigint"), (INT32, "int"), (DOUBLE, "double"), (FLOAT, "float"), (BOOL, "boolean"), (TIMES, "timestamp"), (("date",), "date")):
        if name in names:
            return kind
    return "string"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parse(df: DataFrame, fields: list[str], value: str = "value", into: str = "_fields") -> DataFrame:
    """Adds struct `into` with a variant for each field and boolean `_valid`: the value is JSON. A valid
    value that is no object has null fields. Only the named fields are read from the text."""
    ddl = ", ".join(f"{_q(f)} variant" for f in [*dict.fromkeys(fields)]) + (", " if fields else "") + "`_malformed` string"
    parsed = F.from_json(F.col(value), ddl, {"columnNameOfCorruptRecord": "_malformed"})
    out = df.withColumn(into, parsed)
    whole = F.expr(f"try_parse_json({_q(value)})").isNotNull()
    ok = F.col(into).isNotNull() & F.col(f"{into}._malformed").isNull()
    return out.withColumn("_valid", F.coalesce(ok | whole, F.lit(False)))


def text_of(v: Column) -> Column:
    """A variant as text: strings as they are, other values as JSON text; JSON null is 'null'."""
    t = F.to_json(v)
    return F.when(t.startswith('"'), F.try_variant_get(v, "$", "string")).otherwise(t)


def kind_of(v: Column) -> Column:
    """string, number, bool, null, array or object; null where the field is missing."""
    first = F.substring(F.to_json(v), 1, 1)
    return (
        F.when(first == '"', "string").when(first.isin("t", "f"), "bool").when(first == "n", "null")
        .when(first == "[", "array").when(first == "{", "object").when(first.isNotNull(), "number")
    )


def long_of(v: Column) -> Column:
    """A number as a 64-bit integer, truncated towards 0; null for other kinds and out of range."""
    return F.when(kind_of(v) == "number", F.try_variant_get(v, "$", "bigint"))


def timestamp_of_text(s: Column) -> Column:
    return F.when(s.rlike(TIMESTAMP), s.try_cast("timestamp"))


def decode(v: Column, type_name: str) -> Column:
    """A variant as a column of the declared type; what the type doesn't accept is null."""
    kind = kind_of(v)
    if type_name in TEXT:
        return F.when(kind != "null", text_of(v))
    if type_name in INT64:
        return long_of(v)
    if type_name in INT32:  # wraps around as 32 bits do
        return (((long_of(v) + F.lit(1 << 31)).bitwiseAND(F.lit((1 << 32) - 1))) - F.lit(1 << 31)).cast("int")
    if type_name in DOUBLE + FLOAT:
        return F.when(kind == "number", F.try_variant_get(v, "$", "double")).cast("float" if type_name in FLOAT else "double")
    if type_name in BOOL:
        return F.when(kind == "bool", F.try_variant_get(v, "$", "boolean"))
    text = F.try_variant_get(v, "$", "string")
    if type_name == "timestamp_ms":
        of_number = F.timestamp_millis(long_of(v))
        return F.when(kind == "number", of_number).when(kind == "string", F.date_trunc("millisecond", timestamp_of_text(text)))
    if type_name == "timestamp_us":
        return F.when(kind == "number", F.timestamp_micros(long_of(v))).when(kind == "string", timestamp_of_text(text))
    if type_name == "date":
        day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
        return F.when(kind == "number", F.date_add(F.lit("1970-01-01").cast("date"), long_of(v).cast("int"))).when(kind == "string", F.coalesce(day, timestamp_of_text(text).cast("date")))
    return F.expr("null").cast("string")


def encode(c: Column, type_name: str) -> Column:
    """What a file stores: texts stay nullable and empty ones become null, others get a default."""
    if type_name in TEXT:
        return F.when(c != "", c)
    if type_name in INT64 + INT32 + DOUBLE + FLOAT:
        return F.coalesce(c, F.lit(0).cast(spark_type(type_name)))
    if type_name in BOOL:
        return F.coalesce(c, F.lit(False))
    if type_name in TIMES:
        return F.coalesce(c, F.timestamp_seconds(F.lit(0)))
    if type_name == "date":
        return F.coalesce(c, F.lit("1970-01-01").cast("date"))
    return F.coalesce(c, F.lit(""))


def project(df: DataFrame, schema: dict[str, str], fields: str = "_fields", taken: tuple[str, ...] = (), stored: bool = False) -> list[Column]:
    """The declared columns in order of name. `taken` are columns of df that win over payload fields
    of the same name; stored: with the defaults of `encode`."""
    out = []
    for name in sorted(schema):
        c = F.col(_q(name)).cast(spark_type(schema[name])) if name in taken else decode(F.col(f"{fields}.{_q(name)}"), schema[name])
        out.append((encode(c, schema[name]) if stored else c).alias(name))
    return out
