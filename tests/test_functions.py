import json

import pytest
from pyspark.sql import functions as F

from siltlake.functions import coerce, jsonflat, murmur
from siltlake.sources import bufferlog

CASES = [
    ("utf8", '"hello"', "hello"), ("utf8", "123", "123"), ("utf8", '{"a":1}', '{"a":1}'), ("utf8", "[1,2]", "[1,2]"),
    ("int64", "42", 42), ("int64", "42.9", 42), ("int64", "-42.9", -42), ("int64", '"42"', None), ("int64", "true", None),
    ("int32", "42", 42), ("int32", "5000000000", 705032704), ("float64", "3.14", 3.14), ("float64", "42", 42.0), ("float64", '"NaN"', None), ("float32", "3.5", 3.5),
    ("bool", "true", True), ("bool", "false", False), ("bool", '"true"', None),
    ("timestamp_ms", "1704067200000", 1704067200000), ("timestamp_ms", '"2024-01-01T00:00:00Z"', 1704067200000), ("timestamp_ms", '"2024-01-01"', None), ("timestamp_ms", '"2024-01-01 10:15"', None),
    ("timestamp_ms", '"2024-01-01T02:00:00+02:00"', 1704067200000), ("timestamp_ms", '"2024-01-01 00:00:00.123456"', 1704067200123),
    ("json", '{"nested":"value"}', '{"nested":"value"}'), ("json", "[1,2,3]", "[1,2,3]"), ("date", '"2024-01-02"', "2024-01-02"), ("mystery", "1", None),
    *((t, "null", None) for t in ("utf8", "int64", "float64", "bool", "timestamp_ms")),
]


def test_decoding(spark):
    rows = [(i, t, '{"f":' + j + "}") for i, (t, j, _) in enumerate(CASES)]
    df = coerce.parse(spark.createDataFrame(rows, "i int, t string, value string"), ["f"])
    for kind in {t for t, _, _ in CASES}:
        c = coerce.decode(F.col("_fields.f"), kind)
        c = F.unix_millis(c) if kind == "timestamp_ms" else c.cast("string") if kind == "date" else c
        got = {r.i: r.v for r in df.where(F.col("t") == kind).select("i", c.alias("v")).collect()}
        assert got == {i: want for i, (t, _, want) in enumerate(CASES) if t == kind}


def test_validity_and_defaults(spark):
    rows = [(0, '{"f":""}'), (1, "not json"), (2, ""), (3, None), (4, "[1]"), (5, "null"), (6, "{}")]
    df = coerce.parse(spark.createDataFrame(rows, "i int, value string"), ["f"])
    assert {r.i: r._valid for r in df.collect()} == {0: True, 1: False, 2: False, 3: False, 4: True, 5: True, 6: True}
    kinds = {"a": "int64", "b": "float64", "c": "bool", "d": "timestamp_ms", "e": "utf8", "f": "utf8", "g": "other"}
    out = coerce.parse(df.select("i", "value").where("i = 0"), list(kinds))
    row = out.select(*coerce.project(out, kinds, stored=True)).withColumn("d", F.unix_millis("d")).first()
    assert tuple(row) == (0, 0.0, False, 0, None, None, "")


VECTORS = {"a": 0x85555565F6597889, "c": 0x8E38DF6C4A1F74D7, "url": 0x45A14676BFA7DC70, "user.name": 0x7E04B6BA42FB35C8, "a.b.c.d.e.f.g": 0xA6A7FC7994F0F2EC, "hello": 0xCBD8A7B341BD9B02}


def test_murmur():
    assert {k: murmur.h1(k.encode()) for k in VECTORS} == VECTORS
    assert hex(murmur.h1(b"The quick brown fox jumps over the lazy dog")) == "0xe34bbc7bbc071b6c"
    assert murmur.bucket("arr", 4) == 2 and murmur.bucket("k", 256) == 178
    assert len({murmur.bucket(f"key{i}", 8) for i in range(100)}) == 8


@pytest.mark.parametrize("literal, shown", [("2.0", "2"), ("1.50", "1.5"), ("1e3", "1000"), ("1e21", "1e+21"), ("123456789012345678901", "123456789012345680000"), ("0.0001", "0.0001"), ("0.00001", "1e-05"), ("-0.0", "-0"), ("1.5e-7", "1.5e-07"), ("1e400", "+Inf"), ("100", "100"), ("12345678.9", "12345678.9")])
def test_floats(literal, shown):
    if literal == "123456789012345678901":
        assert float(jsonflat.shown_float(literal)) == float(shown)
    else:
        assert jsonflat.shown_float(literal) == shown


def test_flatten():
    leaves = {x[0]: dict(zip(jsonflat._NAMES, x)) for x in jsonflat.flatten('{"b":{"c":2.50,"":1},"a":"<x>","n":null,"e":"","big":18446744073709551615,"l":[1, {"y":1,"x":"<"}],"o":{}} trailing', 4)}
    assert list(leaves) == ["a", "b.", "b.c", "big", "e", "l", "n"]
    assert (leaves["b.c"]["text"], leaves["b.c"]["shown"], leaves["b.c"]["depth"], leaves["b.c"]["kind"]) == ("2.50", "2.5", 1, jsonflat.FLOAT)
    assert leaves["big"]["kind"] == jsonflat.STRING and leaves["e"]["kind"] == leaves["n"]["kind"] == jsonflat.NULL
    assert leaves["l"]["text"] == '[1,{"x":"\\u003c","y":1}]' and json.loads(leaves["l"]["json"]) == '[1,{"x":"\\u003c","y":1}]'
    assert leaves["a"]["json"] == '"\\u003cx\\u003e"'
    assert jsonflat.flatten('{"a":1,"a":2}', 4)[0][5] == "2"
    assert [jsonflat.flatten(t, 4) for t in (None, "", " ", "not json", "[1]", '{"a":NaN}', "5", "[" * 100_000)] == [None] * 8
    assert jsonflat.flatten("{}", 4) == jsonflat.flatten("null", 4) == []
    assert jsonflat.flatten('{"k":"\\ud800"}', 4)[0][5] == "�"


def test_buffer_log(spark, tmp_path):
    data = b""
    for r in (b'{"event":"a"}', b"", b"\xc3\xa9"):
        data = bufferlog.append(data, r)
    assert list(bufferlog.records(data + b"\x00\x00\x00\x09torn")) == [b'{"event":"a"}', b"", b"\xc3\xa9"]
    (tmp_path / "x.log").write_bytes(data)
    assert [(r.record, r.value) for r in bufferlog.read(spark, str(tmp_path)).collect()] == [(0, '{"event":"a"}'), (1, ""), (2, "é")]
