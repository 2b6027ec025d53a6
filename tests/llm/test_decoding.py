import random

import public_tokenizers
import pytest

from siltlake.llm import packing, unigram
from siltlake.llm.common import read_table

PATH = public_tokenizers.path("piece_bpe_32k.model")
LONG = ["x" * 300, "ab" * 2_000 + " " + "漢字" * 200, "word " + "é" * 500 + " word"]


@pytest.fixture(scope="module")
def model():
    return unigram.load(PATH)


def test_decoding_gives_the_texts_back(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    back = unigram.decode_documents(unigram.encode_documents(docs))
    assert back.count() == docs.count()
    same = docs.selectExpr("doc_id", "coalesce(text, '') AS text").exceptAll(back)
    assert same.isEmpty()


def test_decoding_of_odd_ids(spark, model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    some = sp.encode("some words")
    rows = [(1, None), (2, []), (None, some), (4, [sp.bos_id(), *some, sp.eos_id()]), (5, [*some, None, -1, 10**9]), (6, [model.bytes_at[0xC3], model.bytes_at[0xA9]]), (7, [model.bytes_at[0xC3]])]
    got = unigram.decode_documents(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()
    assert [(r.doc_id, r.text) for r in got] == [(1, ""), (2, ""), (None, "some words"), (4, "some words"), (5, "some words���"), (6, "é"), (7, "�")]


def test_empty_table(spark):
    out = unigram.decode_documents(spark.createDataFrame([], "doc_id int, ids array<long>, text string"))
    assert out.columns == ["doc_id", "text"] and out.isEmpty()


def test_memories_keep_no_long_words(model):
    m = unigram.Unigram(["<unk>", "▁", "a", "b", *(f"<{i}>" for i in range(256))], {1: -1.0, 2: -2.0, 3: -3.0}, list(range(4, 260)))
    texts = [*LONG, "a b ab", "a b ab"]
    first, counts = m.encode(texts), m.counts(texts)
    assert first == m.encode(texts) and counts == m.counts(texts) == [len(x) // 4 for x in first]
    assert 0 < len(m.known) and max(map(len, m.known)) <= m.longest and max(map(len, m.counted)) <= m.longest


def test_packing_remembers_no_long_chunks():
    t = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    texts = [*LONG, " ".join("".join(rng.choices("abcé.,", k=rng.randint(1, 400))) for _ in range(50))]
    want = [t.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    for _ in range(2):
        assert [list(memoryview(x).cast("I")) for x in t.ids(texts)] == want
    assert max(map(len, t.chunks.new)) <= packing.REMEMBERED
