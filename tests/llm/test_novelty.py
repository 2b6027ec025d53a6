"""op1's novel spans: against a plain search, recall and false alarms, windows, and time on hostile texts."""

import random
import re
import string
import time
from collections import Counter

import pytest

from siltlake.llm import secrets
from siltlake.llm.common import read_table

P = secrets.SecretParams()
KEY = "Zq7vK2mXw9RtB4nLpE8sYc3H"
ALPHABETS = {"letters and digits": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/"}
IDENTIFIERS = """authentication_backend2 AccessTokenProvider2 user_session_id_42 com.example.service.Auth2Handler password_reset_required_v2
SecretManagerClientV3 config/settings/production2.yml ResponseEntity200 handler_registry_entry17 https.example.com/api/v1/users
isAuthenticated2FA InternationalOrganization2 version_1.2.3_final access_control_list_2 my_database_name_1 UserAccountService
ConnectionPoolManager AbstractFactoryBean /usr/share/doc/package2""".split()
CONTEXTS = ["the access credential is {} for all of us", "Then it was that the one for this; the access key {} in the of\nthose, and the last. It is said that the token was used.", "AUTH {}"]


def plain(text, base, dictionary):
    """Every run tried by itself, every place looked up by itself."""
    words = [m.span() for m in secrets.SENSITIVE.finditer(text)]
    clear = lambda s, e: not any(a < e and s < b for a, _, b in base)
    near = lambda at: any(e <= at <= e + P.reach for _, e in words)
    pieces = []
    for m in re.finditer(r"[A-Za-z0-9+/_.=-]{12,}", text):
        marks = sorted({m.start(), m.end()} | {x for s, e in words if s < m.end() and e > m.start() for x in (max(s, m.start()), min(e, m.end()))})
        for s, e in zip(marks, marks[1:]):
            if any(a < e and s < b for a, b in words) or not (near(s) and any(x <= s <= x + P.reach for _, x in words)):
                continue
            run = text[s:e] if text[s:e].endswith("==") else text[s:e].rstrip(".=")
            s += len(run) - len(run.lstrip("=._-"))
            run = run.lstrip("=._-")
            kinds = sum(bool(re.search(k, run)) for k in ("[0-9]", "[a-z]", "[A-Z]"))
            if len(run) >= 12 and kinds >= 2 and clear(s, s + len(run)):
                pieces.append((s, s + len(run)))
    taken = []
    for s, e in pieces:
        run = text[s:e]
        n, found = e - s, []
        for low, high in ((max(0, s - P.before - n), s), (e, e + P.after + n)):
            found += [low + m.start() for m in re.finditer(re.escape(run), text[low:high])]
        others = [x for x in found if near(x) or not clear(x, x + n)]
        if secrets.novelty(text, s, e, P, others, dictionary) * (e - s) >= P.threshold * (e - s) + P.unit:
            taken.append((s, 3, e))
    own = list(taken)
    any_of = "|".join(re.escape(r) for r in sorted({text[s:e] for s, _, e in own}, key=len, reverse=True))
    for m in re.finditer(any_of, text) if own else ():
        if clear(*m.span()) and not any(s < m.end() and m.start() < e for s, _, e in own):
            taken.append((m.start(), 3, m.end()))
    return sorted(set(taken))


def test_equals_a_plain_search():
    rng = random.Random(8)
    key = lambda: "".join(rng.choice(ALPHABETS["base64"]) for _ in range(rng.randrange(8, 30)))
    for _ in range(300):
        keys = [key() for _ in range(3)]
        parts = [*keys, *IDENTIFIERS, "token", "the access", "password", "auth", "of the", "and so on, until the end of the day. ", "secret_", "api_key=", "=", "\n", "bearer ", "é", "0123456789abcdef"]
        text = "".join(rng.choice(parts) + rng.choice(["", " ", " ", ": "]) for _ in range(rng.randrange(2, 30)))
        base = secrets.base_spans(text)
        assert secrets.novel_spans(text, base, P) == plain(text, base, secrets.CODE), text


def test_the_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    # keys that no pattern knows, put into some texts
    from pyspark.sql import functions as F

    docs = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(f"\nThe access credential is {KEY} from now on."))).otherwise(F.col("text")))
    dictionary = secrets.corpus_dictionary(docs)
    count = Counter(w for r in docs.collect() for w in set(secrets.IDENTIFIER_WORD.findall(r.text or "")))
    top = sorted((w for w, n in count.items() if n > 1), key=lambda w: (-count[w], w))[: P.dictionary_words]
    assert dictionary == "\n".join([secrets.CODE.decode(), *reversed(top)]).encode()
    rows = {r.doc_id: r for r in secrets.scan_documents(docs).collect()}
    for r in docs.collect():
        base = secrets.base_spans(r.text or "")
        assert rows[r.doc_id].spans == secrets.written(base + plain(r.text or "", base, dictionary))
        if r.text and r.doc_id % 7 == 0:
            at = r.text.index(KEY)
            assert f"novel:{at}:{at + len(KEY)}" in rows[r.doc_id].spans.split(",")


@pytest.fixture(scope="module")
def dictionary():
    """As of a corpus that holds the identifiers' words, among others."""
    rng = random.Random(1)
    words = [w for i in IDENTIFIERS for w in secrets.IDENTIFIER_WORD.findall(i)]
    words += ["".join(rng.choice("aeinorstlu") for _ in range(rng.randrange(4, 9))) for _ in range(3000)]
    rng.shuffle(words)
    return secrets.CODE + b"\n" + "\n".join(dict.fromkeys(words)).encode()


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("length", [12, 16, 20, 32, 64])
def test_recall(dictionary, alphabet, length):
    rng = random.Random(length)
    for context in CONTEXTS:
        found = 0
        for _ in range(300):
            key = rng.choice("QXZ") + "".join(rng.choice(ALPHABETS[alphabet]) for _ in range(length - 2)) + rng.choice("789")
            text = context.format(key)
            found += (text.index(key), 3, text.index(key) + length) in secrets.novel_spans(text, [], P, dictionary)
        assert found / 300 >= 0.9, context


def test_false_alarms(dictionary):
    for context in CONTEXTS:
        alarms = [w for w in IDENTIFIERS if secrets.novel_spans(context.format(w), [], P, dictionary)]
        assert len(alarms) <= 1, alarms


def test_windows():
    for gap in range(1, 60):
        text = "x token" + " " * gap + KEY + " end"
        found = secrets.novel_spans(text, [])
        assert found == ([(7 + gap, 3, 7 + gap + len(KEY))] if gap <= P.reach else []), gap
    assert [(text[s:e]) for text in (f"my_access_token_{KEY}",) for s, _, e in secrets.novel_spans(text, [])] == [KEY]


HOSTILE = {
    "one run of sensitive words": "token" * 200_000,
    "sensitive words": "token " * 170_000,
    "one run around a sensitive word": "".join(random.Random(2).choices(string.ascii_letters + string.digits, k=500_000)) + "auth" + "".join(random.Random(3).choices(string.ascii_letters + string.digits, k=500_000)),
    "nested repeats": " ".join("token " + "aB1" * k for k in range(4, 800)),
    "one key over and over": f"token {KEY} " * 32_000,
    "base spans": "token 0123456789abcdef0 " * 42_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_a_megabyte_takes_seconds(name):
    began = time.perf_counter()
    base, novel = secrets.scan(HOSTILE[name])
    assert time.perf_counter() - began < 10
    if name == "one key over and over":
        assert len(novel) == 32_000
