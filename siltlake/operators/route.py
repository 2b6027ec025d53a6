"""Templates to path columns: literals and {{field}} placeholders. A dotted placeholder stays as it is."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltlake.functions.coerce import kind_of, long_of, text_of

PLACEHOLDER = re.compile(r"\{\{(\w+)\}\}")


@dataclass(frozen=True)
class Template:
    text: str

    @property
    def pieces(self) -> list[tuple[bool, str]]:
        """(is a field, text), in order."""
        return [(i % 2 == 1, x) for i, x in enumerate(PLACEHOLDER.split(self.text)) if i % 2 or x]

    @property
    def fields(self) -> list[str]:
        return list(dict.fromkeys(x for is_field, x in self.pieces if is_field))

    def reads(self) -> list[str]:
        """Payload fields that the path needs: a date comes from the timestamp."""
        return list(dict.fromkeys("timestamp" if f == "date" else f for f in self.fields))


def _path(template: Template, value) -> Column:
    parts = [value(x) if is_field else F.lit(x) for is_field, x in template.pieces]
    return F.concat(*parts) if parts else F.lit("")


def pipeline_path(template: Template, fields: str = "_fields", now: Column | None = None, numeric_time: bool = False) -> Column:
    """The path of a parsed message. team_id is a number, else 0; date is the day of a text timestamp
    as yyyy/mm/dd, else today (numeric_time: a number is taken as epoch milliseconds); of other fields
    texts are taken raw, numbers as integers, further kinds as JSON text, missing ones as nothing.
    Dots between slashes are broken up, so that no value climbs out of the target directory."""
    today = F.date_format(now if now is not None else F.current_timestamp(), "yyyy/MM/dd")

    def value(name: str) -> Column:
        v = F.col(f"{fields}.`{'timestamp' if name == 'date' else name}`")
        if name == "team_id":
            return F.coalesce(long_of(v), F.lit(0)).cast("string")
        if name == "date":
            s = F.try_variant_get(v, "$", "string")
            day = F.when((kind_of(v) == "string") & (F.octet_length(s) >= 10), F.concat_ws("/", F.substring(s, 1, 4), F.substring(s, 6, 2), F.substring(s, 9, 2)))
            if numeric_time:
                day = F.coalesce(day, F.date_format(F.timestamp_millis(long_of(v)), "yyyy/MM/dd"))
            return F.coalesce(day, today)
        number = F.coalesce(long_of(v).cast("string"), text_of(v))
        return F.coalesce(F.when(kind_of(v) == "number", number).otherwise(text_of(v)), F.lit(""))

    return safe(_path(template, value))


def safe(path: Column) -> Column:
    return F.regexp_replace(path, r"(^|/)\.\.(?=/|$)", "$1__")


def generic_path(template: Template, json: str = "value") -> Column:
    """The path by top-level fields of a JSON text, without the special cases; anything missing, or a
    text that is no JSON, leaves its segment empty."""
    return _path(template, lambda name: F.coalesce(F.get_json_object(F.col(json), f"$['{name}']"), F.lit("")))


def path_of_map(template: Template, values: str) -> Column:
    """The path by a map column of texts."""
    return _path(template, lambda name: F.coalesce(F.element_at(F.col(values), name), F.lit("")))


def extract_fields(template: Template, json: str = "value") -> Column:
    """Map of the template's fields that the JSON text has."""
    pairs = [x for f in template.fields for x in (F.lit(f), F.get_json_object(F.col(json), f"$['{f}']"))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")


def parse_event(template: Template, json: str = "value", time: str = "timestamp") -> Column:
    """Struct of the text, its path, its time and the fields found."""
    return F.struct(F.col(json).alias("data"), generic_path(template, json).alias("partition_path"), F.col(time).alias("timestamp"), extract_fields(template, json).alias("fields"))
