"""op9 against brute force: every pair that shares a shingle, counted exactly on strings."""

from collections import defaultdict
from itertools import combinations

import numpy as np

from siltlake.llm import minhash
from siltlake.llm.common import read_table


def brute(rows, words, percent=80):
    sets = {}
    for i, text in rows:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
        sets[i] = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    common = defaultdict(int)
    for ids in at.values():
        for a, b in combinations(ids, 2):
            common[a, b] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for words in (2, 5):
        assert as_dict(minhash.near_duplicates(docs, minhash.MinHashParams(words=words))) == brute(rows, words)


def test_large_group_of_near_copies_in_small_blocks(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        w = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 9)):
            w[j] = f"x{rng.integers(0, 40)}"
        rows.append((i + 5, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = as_dict(minhash.near_duplicates(docs, minhash.MinHashParams(words=2, block_rows=8)))
    want = brute(rows, 2)
    assert got == want and len({c for _, c, _ in want.values()}) > 3


def test_edges_of_the_input(spark):
    rows = [(7, None, "a"), (3, "", "a"), (4, " \t\n", "a"), (9, "One", "b"), (8, "one", "b"), (2, "x y", "c"), (1, "X  Y", "c"), (None, "x y", "d"), (6, "cafÉ a", "e"), (5, "café a", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bands string")
    got = as_dict(minhash.near_duplicates(docs, minhash.MinHashParams(words=2)))
    assert got == {7: (0, 7, True), 3: (0, 3, True), 4: (0, 4, True), 9: (1, 8, False), 8: (1, 8, True), 2: (1, 1, False), 1: (1, 1, True), None: (1, None, True), 6: (1, 6, True), 5: (1, 5, True)}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    twice = docs.union(docs)
    assert sorted(map(str, minhash.near_duplicates(twice, minhash.MinHashParams(words=2)).collect())) == sorted(2 * list(map(str, minhash.near_duplicates(docs, minhash.MinHashParams(words=2)).collect())))


def test_signature_estimates_similarity():
    p = minhash.MinHashParams(words=2)
    with np.errstate(over="ignore"):
        a, b = (minhash.shingle_set(" ".join(f"w{i}" for i in r), 2) for r in (range(0, 400), range(40, 440)))
        same = (minhash.signature(a, p) == minhash.signature(b, p)).mean()
    assert abs(same - 359 / 439) < 0.12
