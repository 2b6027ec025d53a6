import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from siltlake.llm import packing
from siltlake.llm.common import read_table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return packing.WordTokenizer(PATH)


def check_pieces(rows, ids, window):
    """Every id in exactly one piece, windows gapless and full but the last."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    total = sum(map(len, ids.values()))
    assert set(by_window) == set(range(-(-total // window)))
    for k, pieces in by_window.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == min(window, total - k * window)


def test_whole_table(spark, sf_dir, tok):
    docs = read_table(spark, sf_dir, "documents")
    ids = {r.doc_id: tok.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [packing.END_ID] for r in docs.collect()}
    check_pieces(packing.pack(docs).collect(), ids, 4096)


def test_small_windows_and_edges(spark, tok):
    rows = [(1, None, 5), (2, "", 5), (3, "the cat " * 20_000, 5), (4, "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(3)
    ids = {i: tok.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t, _ in rows}
    check_pieces(packing.pack(docs, window=7).collect(), ids, 7)
    assert packing.pack(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (9, "a b"), (9, "a b")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.doc_tokens) for r in packing.pack(twice).collect()) == [("9", 3), ("9", 3), ("None", 3)]


def test_same_ids_as_the_tokenizer(tok):
    small = packing.WordTokenizer(PATH, chunks=20, parts=20)
    rng = random.Random(1)
    parts = ["The", "the,", "don't", "it's", "''s", "naïve²", "x²y", "½", "ａｂｃ", "z\x1cq", "<|endoftext|>", "a\tb", "ÉTÉ!!", "ß,.", "İx", "ΣΑΣ", "a_b.c-d", "क़ख़", "🙂", "--", "a\xa0b", "­", "ét", "12,5%"]
    for _ in range(200):
        text = rng.choice(["", " ", "\n"]).join([]) + rng.choice([" ", "\n", "  "]).join(rng.choices(parts, k=rng.randint(0, 12)))
        want = tok.tokenizer.encode(text, add_special_tokens=False).ids
        for t in (tok, small):
            assert np.frombuffer(t.ids([text])[0], "<u4").tolist() == want, text


def test_plain_texts_without_encoding_chunks_alone(tok, monkeypatch):
    texts = ["Some text,\r\nwith\ttabs: don't, 12,5% ''s 'RE ÉTÉ!!", "only Only, ONLY. (only)"]
    want = [tok.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    t = packing.WordTokenizer(PATH)
    monkeypatch.setattr(t, "tokenizer", None)
    assert [np.frombuffer(x, "<u4").tolist() for x in t.ids(texts)] == want


def test_any_characters(tok):
    rng = random.Random(2)
    near = [chr(c) for c in range(256)] + list("'''stmdrevl <||>  ") + ["<|endoftext|>", "<|ENDOFTEXT|>", "’", "́", "Σ", "İ", "你", "x" * 300, "7" * 300]
    texts = ["".join(rng.choices(near[10:127] if k % 2 else near, k=rng.randint(0, 40))) for k in range(3000)]
    for t in (tok, packing.WordTokenizer(PATH, chunks=20, parts=20)):
        for text, x in zip(texts, t.ids(texts), strict=True):
            assert np.frombuffer(x, "<u4").tolist() == tok.tokenizer.encode(text, add_special_tokens=False).ids, text
