"""op3's validators: hostile blobs in linear time, revisions of a PDF, and the registered queries against SQL."""

import gzip
import random
import struct
import time
import zlib

import duckdb
import pytest

from siltlake.llm import media, queries
from tests.llm.test_media import GIF, png


def pdf(body=b"", revisions=1):
    out = b"%PDF-1.4\n" + body
    for r in range(revisions):
        at = len(out)
        out += b"xref\n0 1\ntrailer <<>>\nstartxref\n%d\n%%%%EOF\n" % at
    return out[:-1]


def test_pdf_revisions_and_offsets():
    one, three = pdf(b"x" * 50), pdf(b"y" * 9, 3)
    assert media.sniff(three, "text/plain")["type"] == "application/pdf"
    assert media.segments(b"ab" + one + b"\n--" + three + b"junk") == [("application/pdf", 2, len(one)), ("application/pdf", 2 + len(one) + 3, len(three))]
    assert media.segments(one.replace(b"xref\n0 1", b"nothing.")) == []


def test_chains_that_meet():
    inner = media.wav(b"\x01\x02" * 30)
    late = media.wav(b"abcd") + b"RIFF" + struct.pack("<I", 50) + b"WAVE"
    assert media.segments(b"RIFF\x24\x00\x00\x00WAVE" + inner + late) == [("audio/wav", 12, len(inner)), ("audio/wav", 12 + len(inner), 48)]
    odd = b"RIFF" + struct.pack("<I", 4 + 8 + 3 + 1 + 8 + 16 + 8 + 2) + b"WAVEjunk\x03\x00\x00\x00abc\x00fmt \x10\x00\x00\x00" + bytes(16) + b"data\x02\x00\x00\x00xy"
    assert media.Blob(odd).wav(0) == len(odd) and media.Blob(odd[:-1]).wav(0) == 0
    no_data = b"RIFF" + struct.pack("<I", 4 + 8 + 16) + b"WAVEfmt \x10\x00\x00\x00" + bytes(16) + bytes(20)
    assert media.Blob(no_data).wav(0) == 0


def naive_wav(b, at):
    if len(b) - at < 44 or b[at + 8 : at + 12] != b"WAVE":
        return 0
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    pos, seen = at + 12, set()
    while pos + 8 <= min(end, len(b)):
        seen.add(b[pos : pos + 4])
        size = struct.unpack_from("<I", b, pos + 4)[0]
        pos += 8 + size + size % 2
    return end - at if end <= len(b) and pos == end and {b"fmt ", b"data"} <= seen else 0


def test_wav_equals_a_plain_walk():
    rng = random.Random(3)
    for _ in range(400):
        names = [b"fmt ", b"data", b"junk", b"RIFF"]
        chunk = lambda: rng.choice(names) + struct.pack("<I", rng.choice([0, 1, 2, 4, 12, 20])) + bytes(rng.choice([0, 2, 4]))
        b = b"".join(rng.choice([chunk(), chunk(), b"RIFF" + struct.pack("<I", rng.choice([36, 40, 48, 60, 72, 100])) + b"WAVE"]) for _ in range(40))
        known = media.Blob(b)
        for at in range(len(b) - 12):
            if b[at : at + 4] == b"RIFF":
                assert known.wav(at) == naive_wav(b, at)


HOSTILE = {
    "pdf": b"%PDF-1.4 startxref " * 50_000,
    "pdf ends": b"%PDF-1.4 " + b"startxref 99999999 %%EOF " * 40_000,
    "jpeg": b"\xff\xe0\x00\x04\xff\xd8" * 160_000,
    "jpeg scans": b"\xff\xd8\xff\xda\x00\x02" + b"\xff\xd8\xff\xda\x00\x02\x00\xff\x00" * 100_000,
    "png": b"\x89PNG\r\n\x1a\n\x00\x00\x00\x00IHDR" * 60_000,
    "gif": (b"GIF89a" + bytes(6) + b"\x00!\xff\x06GIF89a\x00") * 50_000,
    "wav": b"".join(b"RIFF" + struct.pack("<I", 1_000_000 - 12 * i) + b"WAVE" for i in range(80_000)),
    "bmp": b"BM" * 500_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_a_megabyte_takes_seconds(name):
    began = time.perf_counter()
    media.sniff(HOSTILE[name], None)
    assert time.perf_counter() - began < 8


def test_gzip_is_never_held_whole():
    bomb = gzip.compress(bytes(200_000_000), 9)
    assert media.segments(b"--" + bomb + b"tail") == [("application/gzip", 2, len(bomb))]
    assert media.segments(bomb[:-4]) == []


def test_png_and_gif_in_each_other():
    assert media.segments(GIF + png() + GIF) == [("image/gif", 0, len(GIF)), ("image/png", len(GIF), len(png())), ("image/gif", len(GIF) + len(png()), len(GIF))]
    assert zlib.crc32(png()) == zlib.crc32(media.dot_png())


@pytest.mark.parametrize("name", ["op3_media_columns", "sniff_blobs"])
def test_queries_equal_sql(spark, sf_dir, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = c.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(names).collect())) == sorted(want.fetchall())


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    assert media.media_of_texts(docs.limit(0)).count() == 0 and media.sniffed_texts(docs.limit(0)).count() == 0
    a, b, _ = media.media_of_texts(docs).collect()
    assert a == b
