"""op7's machine against plain rules, its lexicon against plain counts, and what the grammar decides."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from siltlake.llm import toxicity
from siltlake.llm.common import held_out

SYMBOLS = "ITYNRo"


def by_rules(read):
    """What the four transducers write, by windows over the words instead of states."""
    out = []
    for i, s in enumerate(read):
        before = lambda x, n: any(read[k] == x for k in range(max(0, i - n), i))  # noqa: B023, E731
        to = s
        if s == "I" and before("Y", 4):
            to = "J"
        if s == "Y":
            since = [k for k in range(i) if read[k] == "Y"][-1:] or [-1]
            waiting = [k for k in range(max(since[0] + 1, i - 4), i) if read[k] == "I" and "Y" not in read[max(0, k - 4) : k]]
            to = "H" if any(read[k] == "T" for k in range(max(since[0] + 1, i - 3), i)) else "U" if waiting else "Y"
        if to in "IJUH":
            to += "-" * before("N", 4) + "~" * ("R" in read[:i])
        out.append(to)
    return out


def test_composed_machine_equals_its_parts_and_plain_rules():
    rng = random.Random(4)
    for _ in range(3000):
        read = [rng.choice(SYMBOLS + "ooI") for _ in range(rng.randrange(1, 16))]
        state, composed = 0, []
        for s in read:
            state, to = toxicity.GRAMMAR[state, s]
            composed.append(to)
        one_by_one = read
        for part in toxicity.transducers():
            state, wrote = 0, []
            for s in one_by_one:
                state, to = part.step(state, s)
                wrote.append(to)
            one_by_one = wrote
        assert composed == one_by_one == by_rules(read), read


def test_targets_raise_from_either_side():
    m = toxicity.ToxicityModel({"idiot": 4.0})
    bare, before, after = (m.clauses(t)[0] for t in ("the idiot came", "you are an idiot", "idiot that you are"))
    assert before == after > bare
    assert m.clauses("you there. idiot") == [bare]  # another clause's target
    negated, reported = (m.clauses(t)[0] for t in ("never an idiot", "somebody said idiot"))
    assert negated < bare and reported < bare
    kinds = [toxicity.KINDS[int(np.argmax(m.features(t)))] for t in ("the idiot came", "you are an idiot", "i will kill you", "never an idiot", "somebody said idiot")]
    assert kinds == list(toxicity.KINDS)


def clauses_of_structure(n, seed):
    """(text, toxic): the same words in both kinds; only who is spoken of, negation and report differ."""
    rng = random.Random(seed)
    insults = ["clown", "moron", "loser", "trash"]
    fill = ["the", "circus", "came", "by", "a", "garden", "with", "some", "tea", "today"]
    out = []
    for i in range(n):
        w, toxic = insults[i // 2 % 4], i % 2  # every insult as often in either kind
        if toxic:
            core = rng.choice([f"you are a {w}", f"{w} that you are", f"they are a {w}"])
        else:
            core = rng.choice([f"they had tea today with a {w}", f"somebody said {w}", f"you are never a {w}", f"nobody wrote that you are a {w}"])
        out.append((f"{' '.join(rng.choices(fill, k=12))}. {core}. {' '.join(rng.choices(fill, k=12))} x{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100 % 10]}", toxic))
    return out


def test_without_the_grammar_structure_is_lost(spark):
    ids = [r.id for r in spark.range(2000).where(~held_out(F.col("id"))).limit(600).collect()]
    rows = clauses_of_structure(len(ids), 1)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, rows)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    fresh = clauses_of_structure(600, 2)
    idle = {(0, s): (0, s) for s in SYMBOLS}

    def accuracy(machine):
        m = toxicity.ToxicityModel(model.words, model.stems, model.layer, model.threat_weight, machine, model.forms)
        data = np.array([m.features(t) for t, _ in rows])
        if machine is idle:  # the layer may fit what is left
            m.layer = toxicity.fit_layer(data, np.array([y for _, y in rows], float))
        scores = m.score(np.array([m.features(t) for t, _ in fresh]))
        return np.mean((scores >= 0.5) == np.array([y for _, y in fresh]))

    assert accuracy(toxicity.GRAMMAR) >= 0.95
    assert accuracy(idle) <= 0.65


def test_pieces_of_insults_are_no_stems(spark):
    ids = [r.id for r in spark.range(3000).where(~held_out(F.col("id"))).limit(400).collect()]
    ends = [a + b for a in "bcdfgklm" for b in "aeiou"]
    rows = []
    for k, i in enumerate(ids):
        tail = f"q{ends[k % 40]}{ends[k // 40]}"
        if k % 2 == 0:
            rows.append((i, f"some tea and a walk {tail}", 0))
        elif k % 4 == 1:
            rows.append((i, f"some worthless tea and a walk {tail}", 1))
        else:
            rows.append((i, f"grumpf{ends[k % 37]} some grumpf{ends[k % 39]} tea {tail}", 1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert "worthless" in model.words and "grumpf" in model.stems and not any(s in ("wor", "wort", "worth") for s in model.stems)
    score = lambda t: float(model.score(np.array([model.features(t)]))[0])
    assert score("This book is worth reading.") < 0.5 and score("Das Wort") < 0.5
    assert score("grumpfzu and grumpfzo") >= 0.5  # words that no training row holds
    # the marks by plain counts
    texts, n = {}, Counter()
    for i, t, y in rows:
        texts.setdefault((frozenset(toxicity.WORD.findall(t.lower())), y), i)
    count = (Counter(), Counter())
    for words, y in texts:
        n[y] += 1
        count[y].update(words)
    p = toxicity.ToxicityParams()
    odds = {w: math.log((count[1][w] + 0.5) / (n[1] + 1)) - math.log((count[0][w] + 0.5) / (n[0] + 1)) for w in count[1]}
    want = {w: o for w, o in odds.items() if o >= p.least_odds and count[1][w] >= max(p.least_documents, p.least_share * n[1])}
    learned = {w: v for w, v in model.words.items() if w in want or w not in toxicity.INSULTS}
    assert learned.keys() == want.keys() and all(abs(learned[w] - want[w]) < 1e-9 for w in want)


def test_layer_is_the_least_cost():
    rng = np.random.default_rng(3)
    x = np.abs(rng.normal(size=(300, 5)))
    y = (rng.random(300) < 1 / (1 + np.exp(3 - x @ [1.0, 2.0, 2.5, 0.3, 0.4]))).astype(float)
    w = np.array(toxicity.fit_layer(x, y))

    def cost(w):
        g = w[0] + x @ w[1:]
        return np.logaddexp(0, -(2 * y - 1) * g).sum() + ((w[1:] - toxicity.PRIOR[1:]) ** 2).sum() / 2

    assert w[2] >= w[1] >= max(w[4:]) and min(w[1:]) >= 0
    for k in range(6):
        for step in (-0.01, 0.01):
            v = w.copy()
            v[k] += step
            assert cost(v) > cost(w) - 1e-9
    # no evidence against it: the order of the grammar holds
    only_bare = np.zeros((200, 5))
    only_bare[::2, 0] = 2
    layer = toxicity.fit_layer(only_bare, (only_bare[:, 0] > 0).astype(float))
    assert layer[2] >= layer[1] > max(layer[4:]) >= 0


def test_long_text_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "you idiot " * 40_000, 1.0, 2), (2, "a" * 500_000, 1.0, 2), (3, "kill you " * 10, 0.0, 0)], "doc_id long, text string, score double, predicted int")
    model = toxicity.ToxicityModel({"idiot": 4.0})
    assert [(r.doc_id, r.predicted) for r in toxicity.score_documents(docs, model).collect()] == [(1, 1), (2, 0), (3, 1)]
    assert [r.doc_id for r in toxicity.keep_clean(docs, model).collect()] == [2]
