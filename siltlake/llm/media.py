"""Media columns: signature sniffing.

An Aho-Corasick automaton finds the magic bytes of all known formats in one pass over a blob. Each
place is put to its format's validator, which follows the structure, checks its checksums or counts
and gives its length; what passes is a segment. Segments are taken from the left and don't nest at
one level: the segment that starts at 0 and spans the blob is the blob itself, and its declared type
is corrected to it; the rest are embedded and are carved. In the payload of the blob itself the
search goes on, so that media inside media is found.

Formats: WAV (RIFF chunks), PNG (chunk checksums up to IEND), GIF (blocks up to the trailer), JPEG
(markers up to EOI), gzip (inflates, checksum), BMP (header sizes), PDF (up to the last %%EOF before
another header whose startxref leads to a table or an object, so through all its revisions).

Sniffing takes time in proportion to the blob however many magic bytes it holds: formats that are
chains of blocks remember where each chain leads, since chains that meet stay together, and the rest
looks up positions that were found once. gzip alone is inflated anew from each of its magic bytes,
until it breaks; its output is never held.

Defined results: a null text or blob is an empty one. All rows are kept as they come, repeats and
null ids too; equal blobs give equal values. Nothing is shuffled.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import slices

#: Fixed values of the formats: magic bytes and the type they stand for.
MAGIC = {
    b"RIFF": "audio/wav",
    b"\x89PNG\r\n\x1a\n": "image/png",
    b"GIF87a": "image/gif",
    b"GIF89a": "image/gif",
    b"\xff\xd8\xff": "image/jpeg",
    b"\x1f\x8b\x08": "application/gzip",
    b"BM": "image/bmp",
    b"%PDF-": "application/pdf",
}


_PDF_END = re.compile(rb"startxref\s{1,8}(\d{1,12})\s{1,8}%%EOF")
_PDF_TARGET = re.compile(rb"xref|\d{1,10} \d{1,5} obj")


class Blob:
    """The bytes, and what the validators found out about them: each returns the length of the file of
    its format that starts at a place, or 0."""

    def __init__(self, data: bytes):
        self.data = data
        self.riff: dict[int, tuple[int, int, int, int, int]] = {}  # chunk -> next, a later one, depth, fmts and datas from here on
        self.ends: dict[tuple, int] = {}  # (format, place within a file) -> the file's end, or 0

    def _follow(self, key: tuple, **steps) -> int:
        """Where a chain ends. steps: by a key's name, (place...) -> the next key, or the end as a number; each key
        is stepped from once."""
        seen = []
        while not isinstance(key, int) and key not in self.ends:
            seen.append(key)
            key = steps[key[0]](*key[1:])
        end = key if isinstance(key, int) else self.ends[key]
        for k in seen:
            self.ends[k] = end
        return end

    def _chunks(self, at: int) -> None:
        """Enters the chain of RIFF chunks from a place up to where a known chain or the data ends."""
        b, new = self.data, []
        while at not in self.riff and at + 8 <= len(b):
            new.append(at)
            size = struct.unpack_from("<I", b, at + 4)[0]
            at += 8 + size + size % 2
        if at not in self.riff:
            self.riff[at] = (at, at, 0, 0, 0)
        for place in reversed(new):
            after, jump, depth, fmts, datas = self.riff[at]
            # a second link of skew-binary length: ancestors are found in logarithmic time
            far = self.riff[jump]
            link = far[1] if depth - far[2] == far[2] - self.riff[far[1]][2] else at
            name = b[place : place + 4]
            self.riff[place] = (at, link, depth + 1, fmts + (name == b"fmt "), datas + (name == b"data"))
            at = place

    def wav(self, at: int) -> int:
        b = self.data
        if len(b) - at < 44 or b[at + 8 : at + 12] != b"WAVE":
            return 0
        end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
        if end > len(b):
            return 0
        self._chunks(at + 12)
        here = at + 12
        while here < end and self.riff[here][0] != here:
            after, link = self.riff[here][:2]
            here = link if link <= end else after
        first, last = self.riff[at + 12], self.riff[here]
        return end - at if here == end and first[3] > last[3] and first[4] > last[4] else 0

    def png(self, at: int) -> int:
        b = self.data

        def chunk(pos: int):
            if pos + 12 > len(b):
                return 0
            size = struct.unpack_from(">I", b, pos)[0]
            if pos + 12 + size > len(b) or zlib.crc32(memoryview(b)[pos + 4 : pos + 8 + size]) != struct.unpack_from(">I", b, pos + 8 + size)[0]:
                return 0
            return pos + 12 + size if b[pos + 4 : pos + 8] == b"IEND" else ("png", pos + 12 + size)

        end = self._follow(("png", at + 8), png=chunk) if b[at + 12 : at + 16] == b"IHDR" else 0
        return end - at if end else 0

    def gif(self, at: int) -> int:
        b = self.data

        def table(flags: int) -> int:
            return 3 << ((flags & 7) + 1) if flags & 0x80 else 0

        def piece(pos: int):
            return ("gif_piece", pos + b[pos] + 1) if pos < len(b) and b[pos] else pos + 1

        def part(pos: int, images: bool):
            if pos < len(b):
                if b[pos] == 0x3B:
                    return pos + 1 if images else 0
                if b[pos] == 0x21:
                    return ("gif", self._follow(("gif_piece", pos + 2), gif_piece=piece), images)
                if b[pos] == 0x2C and pos + 10 <= len(b):
                    return ("gif", self._follow(("gif_piece", pos + 10 + table(b[pos + 9]) + 1), gif_piece=piece), True)
            return 0

        end = self._follow(("gif", at + 13 + table(b[at + 10]), False), gif=part) if at + 13 <= len(b) else 0
        return end - at if end else 0

    def jpeg(self, at: int) -> int:
        b = self.data

        def segment(pos: int):
            if pos + 4 > len(b) or b[pos] != 0xFF or b[pos + 1] in (0x00, 0xFF, 0xD8, 0xD9):
                return 0
            size = struct.unpack_from(">H", b, pos + 2)[0]
            if size < 2:
                return 0
            to = pos + 2 + size
            return ("jpeg_scan", to) if b[pos + 1] == 0xDA else ("jpeg", to)

        def scan(pos: int):
            # entropy-coded bytes run to the next marker that isn't stuffing or a restart
            i = b.find(b"\xff", pos)
            if i < 0 or i + 1 >= len(b):
                return 0
            if b[i + 1] == 0 or 0xD0 <= b[i + 1] <= 0xD7:
                return ("jpeg_scan", i + 2)
            return i + 2 if b[i + 1] == 0xD9 else ("jpeg", i)

        end = self._follow(("jpeg", at + 2), jpeg=segment, jpeg_scan=scan)
        return end - at if end else 0

    def gzip(self, at: int) -> int:
        d, view, pos = zlib.decompressobj(31), memoryview(self.data), at
        try:
            while not d.eof:
                part = d.unconsumed_tail or view[pos : pos + 65536]
                if not part:
                    return 0
                pos += 0 if d.unconsumed_tail else len(part)
                d.decompress(part, 1 << 20)
        except zlib.error:
            return 0
        return pos - len(d.unused_data) - at

    def bmp(self, at: int) -> int:
        b = self.data
        if at + 54 > len(b):
            return 0
        size, zero, offset, header = struct.unpack_from("<IIII", b, at + 2)
        planes, depth = struct.unpack_from("<HH", b, at + 26)
        ok = zero == 0 and header in (40, 108, 124) and 14 + header <= offset <= size and planes == 1 and depth in (1, 4, 8, 16, 24, 32)
        return size if ok and at + size <= len(b) else 0

    @functools.cached_property
    def _pdf_marks(self) -> tuple[list[int], list[tuple[int, int]]]:
        heads = [m.start() for m in re.finditer(rb"%PDF-", self.data)]
        return heads, [(m.end(), int(m[1])) for m in _PDF_END.finditer(self.data)]

    def pdf(self, at: int) -> int:
        heads, ends = self._pdf_marks
        after = bisect.bisect_right(heads, at)
        until = heads[after] if after < len(heads) else len(self.data)
        k = bisect.bisect_right(ends, (until, 1 << 62)) - 1
        while k >= 0 and ends[k][0] > at:
            end, table = ends[k]
            if at + table < end and _PDF_TARGET.match(self.data, at + table):
                return end - at
            k -= 1
        return 0


VALIDATORS = {"audio/wav": Blob.wav, "image/png": Blob.png, "image/gif": Blob.gif, "image/jpeg": Blob.jpeg, "application/gzip": Blob.gzip, "image/bmp": Blob.bmp, "application/pdf": Blob.pdf}


@functools.lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for magic, kind in MAGIC.items():
        a.add_word(magic.decode("latin-1"), (len(magic), kind))
    a.make_automaton()
    return a


def segments(blob: bytes, start: int = 0) -> list[tuple[str, int, int]]:
    """(type, offset, length) of confirmed media from `start` on, not nested, from the left."""
    out, free, known = [], start, Blob(blob)
    found = sorted((end - n + 1 + start, kind) for end, (n, kind) in _automaton().iter(blob[start:].decode("latin-1")))
    for at, kind in found:
        if at >= free and (n := VALIDATORS[kind](known, at)):
            out.append((kind, at, n))
            free = at + n
    return out


def sniff(blob: bytes | None, declared: str | None = None) -> dict:
    """The corrected type of a blob and the media embedded in it."""
    blob = bytes(blob or b"")
    found = segments(blob)
    whole = [s for s in found if s[1] == 0 and s[2] == len(blob)]
    kind = whole[0][0] if whole else (declared if declared not in VALIDATORS else "application/octet-stream") or "application/octet-stream"
    inside = segments(blob, min(len(blob), 12)) if whole else found
    return {"type": kind, "corrected": kind != declared, "embedded": inside, "carved": [blob[o : o + n] for _, o, n in inside]}


def wav(payload: bytes, rate: int = 8000) -> bytes:
    """The payload as 8-bit mono samples; its length is even."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload


def samples(stored: bytes) -> bytes:
    """The samples of a WAV file, by walking its chunks."""
    if not Blob(stored).wav(0):
        raise ValueError("not a WAV file")
    pos = 12
    while stored[pos : pos + 4] != b"data":
        size = struct.unpack_from("<I", stored, pos + 4)[0]
        pos += 8 + size + size % 2
    return stored[pos + 8 : pos + 8 + struct.unpack_from("<I", stored, pos + 4)[0]]


def padded(text: str | None, to: int = 64) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % to if raw else to), len(raw)


def describe(text: str | None) -> tuple:
    payload, n = padded(text)
    stored = wav(payload)
    seen = sniff(stored, "application/octet-stream")
    back = samples(stored)
    feature = ";".join([seen["type"], f"samples={len(back)}", *(f"{kind}@{o - 44}+{m}" for kind, o, m in seen["embedded"])])
    return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        n, size, digest, tail, media, stored, feature = zip(*map(describe, b.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(size, pa.int64()), pa.array(digest), pa.array(tail, pa.int64()), pa.array(media, pa.int64()), pa.array(stored), pa.array(feature)],
            ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
        )


def media_of_texts(documents: DataFrame) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_described, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def sniff_blobs(blobs: DataFrame, blob: str, declared: str) -> DataFrame:
    """The columns of `blobs` and sniffed_type, corrected, embedded (type, offset, length, bytes)."""
    kind = "array<struct<type: string, offset: long, length: long, bytes: binary>>"
    names = blobs.columns
    schema = blobs.withColumn("sniffed_type", F.lit("")).withColumn("corrected", F.lit(True)).withColumn("embedded", F.lit(None).cast(kind)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            seen = [sniff(x, d) for x, d in zip(b.column(names.index(blob)).to_pylist(), b.column(names.index(declared)).to_pylist())]
            inner = pa.list_(pa.struct([("type", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("bytes", pa.binary())]))
            found = [[{"type": k, "offset": o, "length": n, "bytes": c} for (k, o, n), c in zip(s["embedded"], s["carved"])] for s in seen]
            extra = {"sniffed_type": pa.array([s["type"] for s in seen], pa.string()), "corrected": pa.array([s["corrected"] for s in seen], pa.bool_()), "embedded": pa.array(found, inner)}
            columns = {n: extra.get(n) if n in extra else b.column(i) for i, n in enumerate(names)} | extra
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return blobs.mapInArrow(run, schema)


#: A picture of one dot in two formats, for the query over blobs.
DOT_GIF = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"


def dot_png() -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\x00\xff")) + chunk(b"IEND", b"")


def blobs_of_texts(documents: DataFrame) -> DataFrame:
    """doc_id, blob and declared type: by doc_id a picture that is declared wrongly, the text itself, a picture within
    the text, a picture that is declared rightly, and one that is cut off, each declared in some way."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    png, kind = F.lit(dot_png()), F.pmod(F.col("doc_id"), F.lit(5))
    blob = F.when(kind == 0, F.lit(DOT_GIF)).when(kind == 1, text).when(kind == 2, F.concat(text, png, text)).when(kind == 3, png).otherwise(F.concat(F.substring(png, 1, 40), text))
    declared = F.when(kind == 1, "text/plain").when(kind == 2, "application/pdf").otherwise("image/png")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), blob.alias("blob"), declared.alias("declared"))


def sniffed_texts(documents: DataFrame) -> DataFrame:
    """doc_id, sniffed_type, corrected, embedded (type:offset:length), carved (SHA-256 of what was carved)."""
    rows = sniff_blobs(blobs_of_texts(documents), "blob", "declared")
    embedded = F.array_join(F.transform("embedded", lambda x: F.concat_ws(":", x["type"], x["offset"].cast("string"), x["length"].cast("string"))), ",")
    return rows.select("doc_id", "sniffed_type", "corrected", embedded.alias("embedded"), F.array_join(F.transform("embedded", lambda x: F.sha2(x["bytes"], 256)), ",").alias("carved"))


_HEX_PNG = dot_png().hex()
#: What sniffed_texts gives where no text holds a file by itself.
SQL_BLOBS = f"""
WITH d AS (SELECT doc_id, doc_id % 5 AS k, octet_length(encode(coalesce(text, ''))) AS n FROM documents)
SELECT doc_id,
  CASE k WHEN 0 THEN 'image/gif' WHEN 1 THEN 'text/plain' WHEN 3 THEN 'image/png' ELSE 'application/octet-stream' END AS sniffed_type,
  k NOT IN (1, 3) AS corrected,
  CASE WHEN k = 2 THEN concat('image/png:', n, ':{len(dot_png())}') ELSE '' END AS embedded,
  CASE WHEN k = 2 THEN sha256(unhex('{_HEX_PNG}')) ELSE '' END AS carved
FROM d
"""

#: What media_of_texts gives where no text holds a file. The checksum goes through its 64 bytes bit by bit.
SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, length(h) // 2 AS n, rpad(h, greatest(1, ceil(length(h) / 128))::INTEGER * 128, '0') AS h FROM t),
q AS (SELECT *, length(h) // 2 AS m FROM p),
w AS (
  SELECT *, concat(
    '52494646', printf('%02X%02X%02X%02X', (36 + m) & 255, ((36 + m) >> 8) & 255, ((36 + m) >> 16) & 255, ((36 + m) >> 24) & 255),
    '57415645666D7420100000000100010040', '1F0000401F00000100080064617461',
    printf('%02X%02X%02X%02X', m & 255, (m >> 8) & 255, (m >> 16) & 255, (m >> 24) & 255), h) AS stored
  FROM q
), c AS (
  SELECT *, list_transform(range(0, 64), lambda i: CAST(concat('0x', substr(h, length(h) - 127 + 2 * i, 2)) AS BIGINT)) AS tail FROM w
), r AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, tail), lambda crc, byte:
    list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)) AS crc
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(m AS BIGINT) AS payload_bytes, sha256(unhex(h)) AS payload_sha256, xor(crc, 4294967295::BIGINT) AS tail_crc32,
  CAST(m + 44 AS BIGINT) AS media_bytes, sha256(unhex(stored)) AS media_sha256, concat('audio/wav;samples=', m) AS feature
FROM r
"""
