"""Flattening of JSON texts to leaves, where built-in functions would lose literals.

A leaf has its dotted key, how many objects enclose it, the bits of its kind, its text, its JSON form
within a bucket object, and a number's rendering as a float. Arrays are leaves; their text is compact,
with object keys sorted, and counts as a string. Only the first JSON value of a text is read.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F

from siltlake.functions import murmur

NULL, BOOL, INT, FLOAT, STRING = 0, 1, 2, 4, 8
LEAF = "key string, jkey string, bucket int, kind int, depth int, text string, json string, shown string"
FLAT = f"array<struct<{', '.join(f'{n}: {t}' for n, t in (x.split(' ') for x in LEAF.split(', ')))}>>"
_SPACE = re.compile(r"[ \t\n\r]*")
_ESCAPED = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", " ": "\\u2028", " ": "\\u2029"}


class Number(str):
    """A number's literal."""


def _refuse(name: str):
    raise ValueError(name)


_decoder = json.JSONDecoder(parse_float=Number, parse_int=Number, parse_constant=_refuse)


def quoted(text: str) -> str:
    """A JSON string: non-ASCII as it is, control characters and < > & as escapes."""
    text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    out = json.dumps(text, ensure_ascii=False)
    out = out.replace("\\b", "\\u0008").replace("\\f", "\\u000c") if "\\b" in out or "\\f" in out else out
    return "".join(_ESCAPED.get(c, c) for c in out) if any(c in out for c in _ESCAPED) else out


def compact(value) -> str:
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, str):
        return quoted(value)
    if isinstance(value, list):
        return "[" + ",".join(map(compact, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{quoted(k)}:{compact(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-8", "surrogatepass"))) + "}"
    return {None: "null", True: "true", False: "false"}[value]


def shown_float(literal: str) -> str:
    """The shortest digits of the number; with an exponent below 1e-4 and from 1e21 on."""
    x = float(literal)
    if x in (float("inf"), float("-inf")):
        return "+Inf" if x > 0 else "-Inf"
    if x == 0:
        return "-0" if str(x)[0] == "-" else "0"
    digits, _, exponent = f"{x!r}".partition("e")
    if 1e-4 <= abs(x) < 1e21:
        if exponent:  # Python turns to exponents earlier
            return f"{x:.0f}"
        return digits.removesuffix(".0")
    if not exponent:
        digits, _, exponent = f"{x:e}".partition("e")
        digits = digits.rstrip("0").rstrip(".")
    power = int(exponent)
    return f"{digits.removesuffix('.0')}e{'-' if power < 0 else '+'}{abs(power):02d}"


def kind_of(value) -> int:
    if value is None or value == "" and not isinstance(value, Number):
        return NULL
    if isinstance(value, bool):
        return BOOL
    if isinstance(value, Number):
        if any(c in value for c in ".eE"):
            return FLOAT
        return INT if -(1 << 63) <= int(value) < 1 << 63 else STRING
    return STRING


def leaves(value: dict, prefix: str = "", depth: int = 0) -> Iterator[tuple[str, int, object]]:
    for k, v in value.items():
        if isinstance(v, dict):
            yield from leaves(v, f"{prefix}{k}.", depth + 1)
        else:
            yield prefix + k, depth, v


def found_leaves(text: str | None) -> dict[str, tuple[int, object]] | None:
    """Key -> depth and value; None for blank or undecodable texts and for values that are no objects; JSON
    null is an empty object."""
    if text is None or not text.strip(" \t\n\r"):
        return None
    try:
        value = _decoder.raw_decode(text, _SPACE.match(text).end())[0]
        if value is None:
            return {}
        return {k: (d, v) for k, d, v in leaves(value)} if isinstance(value, dict) else None
    except (ValueError, RecursionError):
        return None


def _plain(text: str) -> str:
    """Lone surrogates replaced."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def flatten(text: str | None, buckets: int) -> list[tuple] | None:
    """Leaves by key; None where found_leaves gives None."""
    try:
        found = found_leaves(text)
        if found is None:
            return None
        out = []
        for key in sorted(found, key=lambda k: k.encode("utf-8", "surrogatepass")):
            depth, v = found[key]
            plain = v if isinstance(v, str) else compact(v)
            form = quoted(plain) if isinstance(v, list) else compact(v)
            name, kind = _plain(key), kind_of(v)
            shown = shown_float(v) if isinstance(v, Number) else None
            plain = "0" if kind == INT and plain == "-0" else _plain(plain)
            out.append((name, _quoted_name(name), murmur.bucket(name, buckets), kind, depth, plain, form, shown))
        return out
    except (ValueError, RecursionError):
        return None


_quoted_name = functools.lru_cache(65_536)(quoted)


def flat(column, buckets: int = 256):
    """Column of FLAT from a column of JSON texts."""

    @F.arrow_udf(FLAT)
    def run(texts: pa.Array) -> pa.Array:
        found = [flatten(t, buckets) for t in texts.to_pylist()]
        ends = [0, *accumulate(len(x) if x else 0 for x in found)]
        columns = list(zip(*(leaf for x in found if x for leaf in x))) or [()] * len(_NAMES)
        kinds = [pa.int32() if n in ("bucket", "kind", "depth") else pa.string() for n in _NAMES]
        leaves_ = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), leaves_, mask=pa.array([x is None for x in found], pa.bool_()))

    return run(column)


def counted_keys(batches: Iterator[pa.RecordBatch], buckets: int, most: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Columns of a scope and then JSON texts -> the scope's columns, key, rows, kinds, max_depth and bucket, partial
    sums of each batch. Only what statistics need is made of a leaf."""
    for b in batches:
        scope = list(zip(*(c.to_pylist() for c in b.columns[:-1]))) if b.num_columns > 1 else [()] * b.num_rows
        count: dict[tuple, list[int]] = {}

        def out() -> pa.RecordBatch:
            arrays = [pa.array([k[i] for k in count], b.schema.field(i).type) for i in range(b.num_columns - 1)]
            arrays += [pa.array([k[-1] for k in count], pa.string()), *(pa.array([v[i] for v in count.values()], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32())))]
            arrays.append(pa.array([murmur.bucket(k[-1], buckets) for k in count], pa.int32()))
            return pa.RecordBatch.from_arrays(arrays, [*b.schema.names[:-1], "key", "rows", "kinds", "max_depth", "bucket"])

        for of, text in zip(scope, b.column(b.num_columns - 1).to_pylist()):
            for key, (depth, v) in (found_leaves(text) or {}).items():
                try:
                    kind = kind_of(v)
                except ValueError:  # beyond the digits that Python reads
                    continue
                at = count.get((*of, key))
                if at is None:
                    at = count[(*of, key)] = [0, 0, 0]
                at[0] += 1
                at[1] |= kind
                at[2] = max(at[2], depth)
            if len(count) >= most:
                yield out()
                count.clear()
        if count:
            yield out()


_NAMES = [x.split(" ")[0] for x in LEAF.split(", ")]
