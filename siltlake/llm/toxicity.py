"""Toxicity: a weighted finite-state pattern grammar.

A lexicon turns the words of a clause into symbols: I (insult, with a weight), T (threat), Y (a person
addressed or spoken of), N (negation), R (a verb of saying), o (other). Four transducers then read the
clause one after the other, each the output of the one before it, composed into one machine:

target    writes J for an insult within four words after a target, and U for a target within four words
          after an insult that had none
threat    writes H for a target within three words after a threat; a threat alone stays without weight
negation  marks with - what the three above wrote within four words after a negation
reported  marks with ~ what they wrote after a verb of saying in the same clause

A symbol of the output that bears weight is a path: aimed (J, U), threat (H), bare (I, an insult in a
clause without target), negated (any with -), reported (any with ~ alone). A document's evidence is the
sum of the weights on each kind of path, and a logistic layer with a coefficient for each kind gives
the score. The coefficients are fitted to labels, drawn to those of `PRIOR` where labels tell little,
and kept in the grammar's order: negated and reported at most bare, bare at most aimed.

The insult lexicon is a short fixed list and what the training labels show: words that mark toxic
training documents (log odds of at least `least_odds`, in at least `least_share` of the toxic ones),
and productive stems. A document shows a stem by `forms` different words that begin with it; a stem that
marks toxic documents as a word must, and from which they make at least `least_forms` different words,
makes insults of a document's words that show it. A piece of one insult, as "worth" of "worthless", is
none. Copies would make any word look like a mark, so of training documents of one label with the same
set of words only one counts; every other one counts.

Training takes at most `bound` labelled rows outside the held-out fifth, those with the least hash of
doc_id; counts are summed on the executors, and the marks, some of those rows' words, come to the
driver. Scoring runs over every row and whole texts, without a shuffle.

Defined results: null text is an empty text, which has no clauses and gets the score of a clean
document. Without training labels of both kinds the coefficients are those of `PRIOR`. Null doc_ids are
scored, and count as not held out. Repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import discard, held_out, materialise, slices, training_ids

THRESHOLD = 0.5

#: Fixed word lists: the grammar's closed classes in four languages, and common insults.
INSULTS = "idiot idiots moron morons imbecile stupid dumb loser losers scum trash worthless pathetic disgusting clown clowns dumbass bastard jerk idiota imbécil estúpido basura imbécile crétin ordure connard dummkopf arschloch abschaum trottel".split()
THREATS = "kill hurt destroy beat shoot stab burn crush matar golpear tuer frapper détruire töten schlagen vernichten".split()
TARGETS = "you your yours yourself he she him her they them these those people du dich dir ihr euch sie tu toi te vous ils elles tú usted ustedes ellos ellas".split()
NEGATIONS = "not never no isn't aren't don't nicht nie kein keine ne pas jamais nunca jamás".split()
REPORTS = "said says say wrote claims claimed called quoted reported told sagte sagt schrieb dit écrit dijo dice escribió".split()
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:,\n]+")
STEM_LENGTHS = range(3, 9)


@dataclass(frozen=True)
class ToxicityParams:
    bound: int = 8000
    least_odds: float = 3.5
    drop_odds: float = -1.0  # a fixed insult with such log odds is none in these texts
    least_share: float = 0.015
    least_documents: int = 5
    forms: int = 2  # different words by which a document shows a stem
    least_forms: int = 6  # different words of a stem in toxic documents
    fixed_weight: float = 4.0


#: The kinds of paths, and their coefficients before labels are seen; first the bias.
KINDS = ("bare", "aimed", "threat", "negated", "reported")
PRIOR = (-4.0, 1.5, 3.0, 3.0, 0.4, 0.5)
#: The share of its weight that a path brings to its clause's score.
SHARE = {"I": 1.0, "J": 1.5, "U": 0.5, "H": 1.0}


class Transducer:
    """States are integers from 0; arcs: (state, symbol) -> (state, symbol). A missing arc goes to
    `default(state)` and writes the symbol that it read."""

    def __init__(self, arcs: dict, default=lambda s: s):
        self.arcs, self.default = arcs, default

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol)) or (self.default(state), symbol)


def compose(parts: list[Transducer], symbols: str) -> dict:
    """The product machine over the states reachable from all zeros: (state, symbol) -> (state, symbol)."""
    table, todo, ids = {}, [(0,) * len(parts)], {(0,) * len(parts): 0}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            out, to = symbol, []
            for part, s in zip(parts, state):
                s, out = part.step(s, out)
                to.append(s)
            if tuple(to) not in ids:
                ids[tuple(to)] = len(ids)
                todo.append(tuple(to))
            table[ids[state], symbol] = (ids[tuple(to)], out)
    return table


def transducers() -> list[Transducer]:
    down = lambda s: max(0, s - 1)  # noqa: E731  scopes end some words on
    # the target transducer's states: words left in a target's scope, times 5, and in a waiting insult's
    both = lambda s: 5 * down(s // 5) + down(s % 5)
    target = {(s, "Y"): (20, "U" if s % 5 else "Y") for s in range(25)} | {(s, "I"): (5 * down(s // 5), "J") if s >= 5 else (4, "I") for s in range(25)}
    threat = {(s, "T"): (3, "T") for s in range(4)} | {(s, y): (0, "H") for s in range(1, 4) for y in "YU"}
    negation = {(s, "N"): (4, "N") for s in range(5)} | {(s, x): (down(s), x + "-") for s in range(1, 5) for x in "IJUH"}
    reported = {(s, "R"): (1, "R") for s in range(2)} | {(1, x): (1, x + "~") for y in "IJUH" for x in (y, y + "-")}
    return [Transducer(target, both), Transducer(threat, down), Transducer(negation, down), Transducer(reported)]


GRAMMAR = compose(transducers(), "ITYNRo")
#: Of a written symbol: its kind's place in KINDS and its share of the weight in the clause's score.
PATHS = {
    x + mark: (3 if "-" in mark else 4 if mark else {"I": 0, "J": 1, "U": 1, "H": 2}[x], SHARE[x] * (0.5 if "-" in mark else 1) * (0.7 if "~" in mark else 1))
    for x in SHARE for mark in ("", "-", "~", "-~")
}


@dataclass
class ToxicityModel:
    words: dict[str, float]  # insult weight of whole words
    stems: dict[str, float] = field(default_factory=dict)  # and of `forms` of a document's words that start so together
    layer: tuple[float, ...] = PRIOR
    threat_weight: float = 3.0
    machine: dict = field(default_factory=lambda: GRAMMAR, repr=False)
    forms: int = 1

    def symbols(self, words: set[str]) -> dict[str, tuple[str, float]]:
        """Symbol and weight of each of a document's different words."""
        shown = _shown(words, self.forms, self.stems) if self.stems else ()
        out = {}
        for word in words:
            w = self.words.get(word)
            if w is None and shown:
                w = next((self.stems[word[:n]] / self.forms for n in reversed(STEM_LENGTHS) if len(word) >= n and word[:n] in shown), None)
            out[word] = ("I", w) if w is not None else (_CLOSED.get(word, "o"), self.threat_weight)
        return out

    def paths(self, text: str) -> list[list[tuple[str, float]]]:
        """Of each clause that matches, the weighted symbols that the machine writes."""
        text = text.lower()
        of = self.symbols(set(WORD.findall(text)))
        if not any(s in "IT" for s, _ in of.values()):
            return []
        out = []
        for clause in CLAUSE.split(text):
            read = [of[w] for w in WORD.findall(clause)]
            if not any(s in "IT" for s, _ in read):
                continue
            state, wrote, waiting = 0, [], 0.0
            for symbol, weight in read:
                state, to = self.machine[state, symbol]
                if symbol == "I":
                    waiting = weight
                if to in PATHS:
                    wrote.append((to, waiting if to[0] == "U" else weight if symbol == "I" else self.threat_weight))
            if wrote:
                out.append(wrote)
        return out

    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses that match."""
        return [sum(PATHS[s][1] * w for s, w in wrote) for wrote in self.paths(text)]

    def features(self, text: str | None) -> tuple[float, ...]:
        """Evidence of each kind."""
        found = [0.0] * len(KINDS)
        for wrote in self.paths(text) if text else ():
            for s, w in wrote:
                found[PATHS[s][0]] += w
        return tuple(np.log1p(found).tolist())

    def score(self, x: np.ndarray) -> np.ndarray:
        x = x.reshape(-1, len(KINDS))
        return 1 / (1 + np.exp(-np.clip(self.layer[0] + x @ np.array(self.layer[1:]), -30, 30)))


_CLOSED = {w: s for s, words in (("T", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}


def _shown(words: set[str], forms: int, among: dict | None = None) -> set[str]:
    """Stems with which at least `forms` of the words begin."""
    count = Counter(w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n and (among is None or w[:n] in among))
    return {s for s, n in count.items() if n >= forms}


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        words = [sorted(set(WORD.findall((t or "").lower()))) for t in b.column(2).to_pylist()]
        copies = [xxhash.xxh3_64_intdigest(" ".join(ws)) >> 1 for ws in words]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(copies, pa.int64()), pa.array(words, pa.list_(pa.string()))], ["doc_id", "y", "copies", "words"])


def _counted(batches: Iterator[pa.RecordBatch], forms: int) -> Iterator[pa.RecordBatch]:
    """What documents show, counted by label: their words (marked by a final space) and their stems."""
    count = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        names = list(count[0].keys() | count[1].keys())
        b = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([count[1][w] for w in names], pa.int64()), pa.array([count[0][w] for w in names], pa.int64())], ["entry", "toxic", "clean"])
        for c in count:
            c.clear()
        return b

    for b in slices(batches):
        for y, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            count[y].update(w + " " for w in words)
            count[y].update(_shown(set(words), forms))
        if len(count[0]) + len(count[1]) > 300_000:
            yield out()
    yield out()


def _docs(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit_layer(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> tuple[float, ...]:
    """Logistic coefficients by Newton's method. A coefficient's distance from its PRIOR costs as much as `pull`
    rows' worth of certainty; the bias is free. Then the grammar's order is enforced."""
    a, w = np.column_stack([np.ones(len(x)), x]), np.array(PRIOR)
    cost = np.array([1e-3, *[pull] * len(KINDS)])
    loss = lambda w: np.logaddexp(0, -(2 * y - 1) * (a @ w)).sum() + (cost * (w - PRIOR) ** 2).sum() / 2
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (q - y) + cost * (w - PRIOR)
        step = np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + np.diag(cost), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-9:
            break
    bias, bare, aimed, threat, negated, reported = w.tolist()
    bare = max(bare, 0.0)
    return bias, bare, max(aimed, bare), max(threat, 0.0), min(max(negated, 0.0), bare), min(max(reported, 0.0), bare)


def train(documents: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    chosen = training_ids(labels, "toxic", p.bound)
    sample = _docs(documents).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")  # bound ids at most
    rows = materialise(sample.mapInArrow(_word_rows, "doc_id long, y int, copies long, words array<string>"), "toxic-words")
    one = rows.groupBy("copies", "y").agg(F.min("doc_id").alias("doc_id"))
    used = rows.join(one, ["copies", "y", "doc_id"], "left_semi").dropDuplicates(["copies", "y", "doc_id"])
    n = {r["y"]: r["n"] for r in used.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    model = ToxicityModel({w: p.fixed_weight for w in INSULTS}, forms=p.forms)
    if not toxic or not clean:
        discard(rows)
        return model
    counts = materialise(used.select("y", "words").mapInArrow(lambda it: _counted(it, p.forms), "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") > 0), "toxic-counts")
    discard(rows)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    is_word = F.endswith("entry", F.lit(" "))
    words = counts.where(is_word).select(F.explode(F.array_distinct(F.array(*(F.substring(F.rtrim("entry"), 1, k) for k in STEM_LENGTHS)))).alias("entry"))
    forms = words.groupBy("entry").agg(F.count("*").alias("forms"))
    known = F.trim("entry").isin(INSULTS)
    marks = counts.withColumn("odds", odds).where(known & is_word | (F.col("toxic") >= max(p.least_documents, p.least_share * toxic)) & (F.col("odds") >= p.least_odds))
    marks = marks.join(forms, "entry", "left").where(is_word | (F.col("forms") >= p.least_forms))
    for entry, weight in marks.select("entry", "odds").collect():
        if not entry.endswith(" "):
            model.stems[entry] = weight
        elif weight >= p.least_odds:
            model.words[entry[:-1]] = weight
        elif weight <= p.drop_odds:
            model.words.pop(entry[:-1], None)
    discard(counts)
    scored = sample.mapInArrow(lambda it: _features(it, model), "doc_id long, y int, x array<double>")
    data = sorted((r.doc_id, r.y, tuple(r.x)) for r in scored.collect())
    model.layer = fit_layer(np.array([r[2] for r in data]), np.array([r[1] for r in data], float))
    return model


def _features(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        x = [model.features(t) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])


def score_documents(documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = model.score(np.array([model.features(t) for t in b.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    scored = _docs(documents).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold, with all their columns."""
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = model.score(np.array([model.features(t) for t in b.column(at).to_pylist()]))
            yield b.filter(pa.array(s < threshold))

    return documents.mapInArrow(run, documents.schema)
