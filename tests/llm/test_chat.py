import random

from siltlake.llm import chat
from siltlake.llm.common import read_table


def brute(rows):
    convs = {}
    for c, t, role, text in set(rows):
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t, role is not None, role, text))
    import hashlib

    key = lambda x: (x[0], x[1] or 0, x[2], x[3] or "", "" if x[4] is None else hashlib.md5(x[4].encode()).hexdigest())
    seqs = {c: tuple((x[3], x[4]) for x in sorted(v, key=key)) for c, v in convs.items()}
    inner = {s[:n] for s in seqs.values() for n in range(1, len(s))}
    first = {}
    for c in sorted(seqs):
        first.setdefault(seqs[c], c)
    return {c for s, c in first.items() if s not in inner}


def rows_of(df):
    return [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]


def test_whole_table(spark, sf_dir):
    df = read_table(spark, sf_dir, "conversations")
    out = chat.format_chats(df).collect()
    kept = brute(rows_of(df))
    assert {r.conv_id for r in out} == kept and len(out) == len({x for x in rows_of(df) if x[0] in kept})


def test_snapshots_collapse(spark):
    rng = random.Random(4)
    rows = []
    for c in range(60):
        base = rng.randint(0, 5)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"b{base} t{t}" if t else "hello") for t in range(rng.randint(1, 9))]
    rows += [(99, t, "user", "same") for t in range(3000)] + [(98, t, "user", "same") for t in range(2999)] + rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = {r.conv_id for r in chat.maximal(df).collect()}
    assert kept == brute(rows) and 99 in kept and 98 not in kept and len(kept) < 20


def test_carry_over_tasks():
    turns = [(1, "a")] * 7 + [(2, "b")] * 3 + [(3, "c")]
    lanes = [(c, *chat._lanes("user", d)) for c, d in turns]

    def fold(rows, state=(0, 0, 0)):
        n, a, b = state
        for _, x, y in rows:
            n, a, b = n + 1, (a * chat.BASES[0] + x + 1) % chat.P, (b * chat.BASES[1] + y + 1) % chat.P
        return n, a, b

    for cuts in ([0, 2, 4, 6, 11], [0, 7, 8, 11], [0, 1, 11]):
        parts = [lanes[s:e] for s, e in zip(cuts, cuts[1:])]
        sums = [(k, p[0][0], p[-1][0], *fold([x for x in p if x[0] == p[-1][0]])) for k, p in enumerate(parts)]
        before = chat.carried(sums)
        for k, s in enumerate(cuts[:-1]):
            want = fold([x for x in lanes[:s] if x[0] == lanes[s][0]])
            assert before.get(k, (0, 0, 0)) == want


def test_edges(spark):
    rows = [(1, 0, None, "x<|im_end|>"), (1, 1, "user", None), (2, 0, None, "x<|im_end|>"), (None, 0, "user", "y"), (3, None, "user", "z"), (3, None, "user", "z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")
    out = sorted((r.conv_id, str(r.turn), r.rendered) for r in chat.format_chats(df).collect())
    assert out == [(1, "0", "<|im_start|>unknown\nx< |im_end| ><|im_end|>\n"), (1, "1", "<|im_start|>user\n<|im_end|>\n"), (3, "None", "<|im_start|>user\nz<|im_end|>\n")]
    assert chat.format_chats(df.limit(0)).count() == 0
