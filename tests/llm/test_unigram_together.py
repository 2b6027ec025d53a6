import random

import numpy as np
import public_tokenizers
import pytest

from siltlake.llm import unigram

LETTERS = "▁thenadrsioé,🙂x漢\ud800\x00\n q"


@pytest.fixture
def model():
    unigram.load.cache_clear()
    yield unigram.load(public_tokenizers.path("piece_bpe_32k.model"))
    unigram.load.cache_clear()


def alone(model, word):
    return np.array(model.viterbi(word), "<i4").tobytes()


def test_paths_together_are_the_paths_alone(model):
    rng = random.Random(5)
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 64))) for _ in range(3_000)] + ["q" * 64, "🙂", "\x00", "▁"]
    want = [alone(model, w) for w in words]
    assert model.viterbi_together(words) == want
    assert [model.viterbi_together([w])[0] for w in words[-40:]] == want[-40:]


def test_equal_scores_give_the_longer_last_piece():
    pieces = ["<unk>", "▁", "a", "b", "ab", "ba", "bab", *(f"<{i}>" for i in range(256))]
    m = unigram.Unigram(pieces, dict.fromkeys(range(1, 7), -1.0), list(range(7, 263)))
    words = ["▁aba", "▁bab", "▁abab", "▁babab", "▁abxab", "▁é", "▁" + "ab" * 20]
    assert m.viterbi_together(words) == [alone(m, w) for w in words]
    assert np.frombuffer(m.viterbi_together(["▁aba"])[0], "<i4").tolist() == [1, 2, 5]


def test_unknown_words_of_many_texts_are_encoded_together(model, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("thenadrsio") for _ in range(rng.randint(1, 20))) for _ in range(100)) for _ in range(100)]
    texts[7] += " " + "x" * 500 + " é🙂漢 "
    want = [b"".join(alone(model, w) for w in model.pretokens(t)) for t in texts]
    one_by_one, viterbi = [], model.viterbi
    monkeypatch.setattr(model, "viterbi", lambda w: one_by_one.append(w) or viterbi(w))
    assert model.encode(texts) == want
    assert one_by_one == ["▁" + "x" * 500]


def test_forgetting_changes_no_ids_and_spares_what_is_asked_for(model):
    small = unigram.Unigram(["<unk>", "▁", "a", "b", *(f"<{i}>" for i in range(256))], {1: -1.0, 2: -2.0, 3: -3.0}, list(range(4, 260)), bound=20)
    rng = random.Random(7)
    for _ in range(100):
        text = " ".join(["ab", *("".join(rng.choice("ab") for _ in range(12)) for _ in range(5))])
        assert small.encode([text]) == [b"".join(alone(small, w) for w in small.pretokens(text))]
        assert "▁ab" in small.known and len(small.known) <= 20


def test_batches_of_texts_of_any_size(model, monkeypatch):
    rng = random.Random(8)
    texts = ["", " ", "a", "  a  ", *("".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 300))) for _ in range(60))]
    want = [b"".join(alone(model, w) for w in model.pretokens(t)) for t in texts]
    for together, rows, fewest in ((1, 1, 1), (100, 7, 1), (100, 7, 5), (1 << 20, 4096, 1), (1 << 20, 4096, 10_000)):
        monkeypatch.setattr(unigram, "TOGETHER", together)
        monkeypatch.setattr(unigram, "ROWS", rows)
        monkeypatch.setattr(unigram, "FEWEST", fewest)
        model.memory = unigram.Memory(model.bound)
        assert model.encode(texts) == want
    assert model.encode([]) == []


def test_few_unknown_words_are_encoded_one_by_one(model, monkeypatch):
    monkeypatch.setattr(model, "viterbi_together", None)
    for text in ("a few words", "and some more of them"):
        assert model.encode([text]) == [b"".join(alone(model, w) for w in model.pretokens(text))]
