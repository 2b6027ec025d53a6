"""Packing: concatenate and cut.

Pass one tokenizes each document once and writes its ids together with its start among the ids of
the task that made it. The totals per task (one row each, so as many as there are tasks, never
documents) become global offsets by a prefix sum. Pass two is a projection: a document's ids lie at
[offset, offset + n) of the concatenation, which is cut every `length` ids; a document that crosses
a cut gives one boundary record for each window that it touches. Only the last window is short.

The order of the concatenation is the order in which pass one's committed tasks wrote their rows, so
a lost executor cannot change it after the table is written.

Defined results: null text is an empty text, which packs as the end id alone. Null or repeated
doc_ids are packed like any other row.
"""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import materialise, slices

WINDOW = 4096
END_ID = 2
LETTERS = rb"a-z\xdf-\xf6\xf8-\xff"
#: The tokenizer's pre-tokens in a plain text, in lower case, as Latin-1 bytes.
CHUNKS = re.compile(rb"[" + LETTERS + rb"]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^ \t\n\r0-9" + LETTERS + rb"]+")
#: The characters of plain texts: common white space, printable ASCII, Latin letters.
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *(c for c in range(0xC0, 0x100) if c not in b"\xd7\xf7")])
LOWER = bytes(ord(chr(c).lower()) for c in range(256))


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for
    itself, the other bytes, in order, for the characters from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = (b for b in range(256) if b not in set(own))
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Memory:
    """Ids of at most about `bound` words: what was not asked for while the newer half filled is forgotten."""

    def __init__(self, bound: int):
        self.half, self.new = bound // 2, Newer({})
        self.of = self.new.__getitem__

    def learn(self, words: list, ids: list[bytes]) -> None:
        for word, x in zip(words, ids, strict=True):
            self.new.asked[word] += x
            if len(word) <= REMEMBERED:
                self.new[word] = x

    def turn(self) -> None:
        self.new.asked = {}
        if len(self.new) > self.half:
            self.new = Newer(dict(self.new))
            self.of = self.new.__getitem__


class Newer(dict):
    """The newer half of a memory. A word that neither half knows gets an empty bytearray, always the
    same one until `asked` is emptied; `Memory.learn` fills it in place."""

    def __init__(self, old: dict):
        self.old, self.asked = old, {}

    def __missing__(self, word):
        x = self.old.get(word)
        if x is None:
            return self.asked.setdefault(word, bytearray())
        self[word] = x
        return x


#: Longer words are encoded anew each time, so that a memory's bytes are bounded with its entries.
REMEMBERED = 256
#: Characters of texts whose unknown words are encoded together.
TOGETHER = 1 << 18


def plain(text: str) -> bytes | None:
    """The text in lower case, as Latin-1 bytes, if it is plain, which marks of special tokens are not."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if raw.translate(None, PLAIN) or b"<|" in raw else raw.translate(LOWER)


class WordTokenizer:
    """Ids of whole texts, through a memory of the ids of their words.

    The tokenizer drops white space and no token spans it or two pre-tokens, so a text's ids are those
    of its pre-tokens, one after the other. In plain texts lower-casing and the pre-tokens' pattern come
    down to a table of bytes and `CHUNKS`. Chunks not yet known are spelled in byte letters and encoded
    together by the same model without its normalizer; the model ends each with a token that carries the
    end-of-word mark, which tells where the next one starts. Other texts are looked up by their parts
    between spaces and line feeds; unknown parts are cut into chunks if they are plain, or else encoded
    one by one by the tokenizer itself."""

    def __init__(self, path: str, chunks: int = 600_000, parts: int = 300_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(spec))
        letters = byte_letters() | {0x20: " "}
        self.spelled = "".join(letters[b] for b in range(256))
        self.chunks, self.parts = Memory(chunks), Memory(parts)
        self.final = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.final[i] = token.endswith("</w>")

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        text = codecs.charmap_decode(b" ".join(chunks).decode("latin-1").encode(), "strict", self.spelled)[0]
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = ((np.flatnonzero(self.final[ids]) + 1) * 4).tolist()
        if len(ends) != len(chunks):
            raise ValueError("the tokenizer does not mark the end of each pre-token")
        raw = ids.tobytes()
        return [raw[start:end] for start, end in zip([0, *ends], ends)]

    def _cut(self, raw: bytes) -> list:
        return list(map(self.chunks.of, CHUNKS.findall(raw)))

    def _found(self, text: str) -> list:
        """Ids of the text's words, one after the other; those of unknown words come with `_learn`."""
        raw = plain(text)
        return list(map(self.parts.of, text.replace("\n", " ").split(" "))) if raw is None else self._cut(raw)

    def _learn(self) -> None:
        parts = list(self.parts.new.asked)
        cut = [None if (raw := plain(x)) is None else self._cut(raw) for x in parts]
        chunks = list(self.chunks.new.asked)
        for at in range(0, len(chunks), 4096):
            self.chunks.learn(chunks[at : at + 4096], self._encode_chunks(chunks[at : at + 4096]))
        alone = lambda x: np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
        self.parts.learn(parts, [alone(x) if c is None else b"".join(c) for x, c in zip(parts, cut)])

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, at = [], 0
        while at < len(texts):
            self.chunks.turn()
            self.parts.turn()
            found, size = [], 0
            while at < len(texts) and size < TOGETHER:
                found.append(self._found(texts[at]))
                size += len(texts[at])
                at += 1
            self._learn()
            out += map(b"".join, found)
        return out


@functools.lru_cache(1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _tokenized(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    part, start, t = TaskContext.get().partitionId(), 0, tokenizer(path)
    end = np.array([END_ID], "<u4").tobytes()
    for b in slices(batches, 128):
        ids = [x + end for x in t.ids([x or "" for x in b.column(1).to_pylist()])]
        n = np.array([len(x) // 4 for x in ids], np.int64)
        starts = start + np.cumsum(n) - n
        start += int(n.sum())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "part", "start", "n", "ids"])


def token_table(documents: DataFrame, path: str) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(docs.mapInArrow(lambda it: _tokenized(it, path), "doc_id long, part int, start long, n long, ids binary"), "tokens")


def pack(documents: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tokens = token_table(documents, path or public_tokenizers.path("word_bpe_49k.json"))
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total")).orderBy("part").collect()  # one row for each task of pass one
    base, rows = 0, []
    for r in totals:
        rows.append((r["part"], base))
        base += r["total"]
    bases = tokens.sparkSession.createDataFrame(rows, "part int, base long")
    placed = tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("start"))
    pieces = placed.withColumn("sequence_id", F.explode(F.expr(f"sequence(at div {window}, (at + n - 1) div {window})")))
    first = F.greatest(F.col("sequence_id") * window - F.col("at"), F.lit(0))
    last = F.least((F.col("sequence_id") + 1) * window - F.col("at"), F.col("n"))
    pieces = pieces.withColumn("piece_start", first).withColumn("length", last - first)
    ids = F.expr("substring(ids, cast(piece_start * 4 + 1 as int), cast(length * 4 as int))")
    return pieces.select(
        "doc_id", F.col("piece_start").alias("start"), "length", F.crc32(ids).alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        "sequence_id", (F.col("at") + F.col("piece_start") - F.col("sequence_id") * window).alias("offset"),
    )
