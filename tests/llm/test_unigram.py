import math
import random

import numpy as np
import public_tokenizers
import pytest

from siltlake.llm import unigram
from siltlake.llm.common import read_table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return unigram.load(PATH)


def score(model, ids):
    return sum(model.scores.get(i, 0.0) for i in ids)


def brute_best(model, pieces, word):
    best = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            s = pieces.get(word[i:j])
            if s is None and j == i + 1:
                s = model.lost
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def test_paths_are_best(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = {sp.id_to_piece(i): s for i, s in model.scores.items()}
    assert all(model.trie.get(p) == sp.piece_to_id(p) for p in list(pieces)[::97])
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choice("thenadrsioé,🙂x漢") for _ in range(rng.randint(1, 14))) for _ in range(300)]
    for w in words:
        ids = model.viterbi(w)
        lost = sum(1 for c in w if c not in pieces)
        assert math.isclose(score(model, ids) + lost * model.lost, brute_best(model, pieces, w), rel_tol=1e-9)
        assert model.decode(ids) == w[1:]
    counts = model.forward_counts(words)
    assert counts == {w: len(model.viterbi(w)) for w in words}


def test_against_the_library_with_the_same_scores(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for i, s in model.scores.items():
        m.pieces[i].score = s
    sp = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    for text in ("The and attion to thanedble the, anea.\nEr", " lead  and   runs ", "日本 🙂\t\x00é", "  ", "x" * 200):
        ids = np.frombuffer(model.encode([text])[0], "<i4").tolist()
        assert math.isclose(score(model, ids), score(model, sp.encode(text)), abs_tol=1e-3)
        assert model.decode(ids) == text == sp.decode(ids)


def test_tables(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    rows = {r.doc_id: r for r in unigram.encode_documents(docs).collect()}
    counts = {r.doc_id: r.n_tokens for r in unigram.count_tokens(docs).collect()}
    assert len(rows) == docs.count() and all(r.round_trip and len(r.ids) == r.n_tokens == counts[i] for i, r in rows.items())


def test_edges(spark, model):
    rows = [(1, None, 0), (2, "", 0), (None, "a ▁b", 0), (3, "word " * 50_000, 0), (3, "q" * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = unigram.encode_documents(docs).collect()
    assert [(r.doc_id, r.n_tokens > 0, r.round_trip) for r in got] == [(1, False, True), (2, False, True), (None, True, False), (3, True, True), (3, True, True)]
    assert [r.n_tokens for r in unigram.count_tokens(docs).collect()] == [r.n_tokens for r in got]
    assert unigram.encode_documents(docs.limit(0)).count() == 0
