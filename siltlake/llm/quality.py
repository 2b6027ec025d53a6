"""Quality classifier: positive-unlabelled learning.

Rows labelled 1 are the trusted positives, rows without a label are unlabelled web text. An additive
model over binned text statistics minimises the non-negative unbiased risk

    prior * E_pos[loss(+g)] + max(0, E_unl[loss(-g)] - prior * E_pos[loss(-g)])

by full-batch Adam, with the sigmoid loss, whose bound keeps confident rows from ruling the bracket;
where the bracket is negative its gradient is ascended instead, which keeps the model from
fitting the unlabelled positives as negatives. The score is the logistic function of g.

The class prior is estimated from positives and unlabelled rows alone, since labels needn't be dealt like
web text: for each half of the rows (by a hash of doc_id) a first model learns the other half with a prior
of 1/2 and scores it, and best-bin estimation (Garg et al. 2021) compares the shares of unlabelled rows and
of positives above each score. It supposes that some scores are reached by hardly any poor text. Labelled negatives are not learned from.

Training takes at most `bound` labelled rows outside the held-out fifth, those with the least hash of
doc_id, and every unlabelled row there. Bin edges are quantiles of counted cells (values cut to
`CELL_BITS` bits of mantissa). The descent is one barrier stage: each task holds its rows' bins, a byte
for each statistic, and every step sums the tasks' gradients as integers, so the model is the same
however the rows are dealt. Cell counts and the model come to the driver, and no rows. Scoring runs
over every row and whole texts, without a shuffle.

Defined results: null text is an empty text; empty texts get a score from their statistics like any
other. Without trusted positives or without unlabelled rows every score is the share of label 1 among
the labelled rows, smoothed by one row of each (0.5 without labels). Null doc_ids are scored, and count as not held out. Repeated rows are scored each.
"""

from __future__ import annotations

import contextlib
import secrets
import socket
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import discard, held_out, materialise, slices, training_ids

THRESHOLD = 0.3
CELL_BITS = 10
UNIT = 2.0**32  # summands are multiples of its inverse
CHUNK = 1 << 16
WAIT_S = 600  # for another task of the descent
SCORE_CELLS = 1024  # in which rows are counted by score
LEAST_PRIOR = 0.01


@dataclass(frozen=True)
class QualityParams:
    bound: int = 8000
    bins: int = 14
    steps: int = 600
    prior_steps: int = 400
    rate: float = 0.05
    ridge: float = 1e-4


_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL, _WIDE = range(7)
_KIND = np.full(256, _SYMBOL)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = _LOWER, _UPPER, _DIGIT, _WIDE
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[ord(c) for c in ".,;:'\"-?"]] = _STOP
N_STATS = 17


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7) if raw else np.zeros(7)
    words = raw.split()
    w = max(1, len(words))
    bare = [x.strip(b".,;:'\"-?!()|") for x in words]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = set(zip(bare, bare[1:]))
    alone = sum(1 for x in bare if not x)
    return [
        np.log1p(w), n / w, len(set(bare)) / w, len(pairs) / max(1, len(bare) - 1), sum(map(bytes.__eq__, bare, bare[1:])) / w,
        kinds[_UPPER] / max(1, kinds[_UPPER] + kinds[_LOWER]), kinds[_DIGIT] / n, kinds[_STOP] / n, kinds[_SYMBOL] / n, kinds[_WIDE] / n, kinds[_SPACE] / n,
        raw.count(b"!") / w, raw.count(b"|") / w, alone / w, len(set(lines)) / max(1, len(lines)), np.log1p(w / max(1, len(lines))), len(zlib.compress(raw, 1)) / (n + 20),
    ]


def _stats_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([statistics(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))], ["doc_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _cells(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells and their counts, for each statistic."""
    cut = (np.ascontiguousarray(x, float).view(np.int64) & -(1 << 52 - CELL_BITS)).view(float)
    for j in range(N_STATS):
        yield np.unique(cut[:, j], return_counts=True)


def _cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            found = list(_cells(_matrix(b.column(0))))
            stats = np.repeat(np.arange(N_STATS, dtype=np.int32), [len(c) for c, _ in found])
            yield pa.RecordBatch.from_arrays([pa.array(stats), pa.array(np.concatenate([c for c, _ in found])), pa.array(np.concatenate([n for _, n in found]), pa.int64())], ["stat", "cell", "n"])


@dataclass
class QualityModel:
    prior: float
    edges: np.ndarray | None = None  # statistic x inner bin edge
    weights: np.ndarray | None = None  # statistic x bin
    bias: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    @property
    def width(self) -> int:
        return self.edges.shape[1] + 1

    def learned(self, prior: float, theta: np.ndarray) -> None:
        self.prior = prior
        self.weights, self.bias = theta[:-1].reshape(N_STATS, self.width), float(theta[-1])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        g = self.bias + self.weights[np.arange(N_STATS), self.binned(x)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _edges(cells: list[tuple[np.ndarray, np.ndarray]], p: QualityParams) -> np.ndarray:
    """Quantiles of each statistic's cells, which are in order."""
    # rare kinds of text lie in the tails
    at = np.sort(np.concatenate([np.linspace(0, 1, p.bins + 1)[1:-1], [0.01, 0.03, 0.97, 0.99]]))
    below = [np.cumsum(n) for _, n in cells]
    return np.stack([c[np.searchsorted(b, at * (b[-1] - 1), side="right")] for (c, _), b in zip(cells, below)])


def _sigmas(rows: np.ndarray, theta: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of rows of bins, by chunks: the parameters that each adds up, and sigma(g)."""
    at = np.arange(N_STATS) * (len(theta) // N_STATS)
    for low in range(0, len(rows), CHUNK):
        x = rows[low : low + CHUNK] + at
        yield x, 1 / (1 + np.exp(-np.clip(theta[x].sum(axis=1) + theta[-1], -30, 30)))


def _sums(rows: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Of rows of bins: their number, and in units the sum of sigma(g) and the sums of its slope by parameter."""
    out = np.zeros(len(theta) + 2, np.int64)
    for x, s in _sigmas(rows, theta):
        d = np.rint(s * (1 - s) * UNIT)  # sums of a chunk are exact in doubles
        by_bin = np.bincount(x.ravel(), np.repeat(d, N_STATS), len(theta) - 1)
        out += np.concatenate([[len(x), np.rint(s * UNIT).sum()], by_bin, [d.sum()]]).astype(np.int64)
    return out


def _alone(sums: np.ndarray) -> np.ndarray:
    return sums


def _descend(positive: np.ndarray, unlabelled: np.ndarray, width: int, prior: float, p: QualityParams, total: Callable = _alone) -> np.ndarray:
    """The parameters, from rows of bins. total: adds up what the tasks that hold rows have."""
    theta = np.zeros(N_STATS * width + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, p.steps + 1):
        of_p, of_u = total(np.stack([_sums(positive, theta), _sums(unlabelled, theta)]))
        of_p, of_u = of_p[1:] / (UNIT * of_p[0]), of_u[1:] / (UNIT * of_u[0])
        negative = of_u[0] - prior * of_p[0]
        of_negative = of_u[1:] - prior * of_p[1:]
        grad = of_negative - prior * of_p[1:] if negative >= 0 else -of_negative
        grad[:-1] += p.ridge * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= p.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta


def _by_score(rows: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Of rows of bins: how many score in each of SCORE_CELLS equal steps."""
    out = np.zeros(SCORE_CELLS, np.int64)
    for _, s in _sigmas(rows, theta):
        out += np.bincount((s * SCORE_CELLS).astype(int), minlength=SCORE_CELLS)
    return out


def best_bin_prior(of_p: np.ndarray, of_u: np.ndarray) -> float:
    """The share of positives among unlabelled rows, from the counts of both by score. Above a score that
    poor text does not reach, the share of unlabelled rows is the prior times that of positives; the score
    taken is the one with the least upper confidence bound (0.9) of that ratio. Kept off 0 and 1."""
    p, u = (np.cumsum(n[::-1]) / n.sum() for n in (of_p, of_u))
    slack = 1.01 * sum(np.sqrt(np.log(4 / 0.1) / (2 * n.sum())) for n in (of_p, of_u))
    p, u = p[p > 0], u[p > 0]
    at = np.argmin((u + slack) / p)
    return float(np.clip(u[at] / p[at], LEAST_PRIOR, 1 - LEAST_PRIOR))


def _learn(positive: list[np.ndarray], unlabelled: list[np.ndarray], width: int, prior: float | None, p: QualityParams, total: Callable = _alone) -> tuple[float, np.ndarray]:
    """The prior, estimated unless it is given, and the parameters, from the two halves of the rows of bins."""
    every = np.concatenate(positive), np.concatenate(unlabelled)
    if prior is None:
        halves = list(zip(positive, unlabelled))
        if not total(np.array([[len(x) for x in half] for half in halves], np.int64)).all():
            halves = [every, every]
        counts = np.zeros((2, SCORE_CELLS), np.int64)
        for learned, other in (halves, halves[::-1]):
            theta = _descend(*learned, width, 0.5, replace(p, steps=p.prior_steps), total)
            counts = counts + total(np.stack([_by_score(x, theta) for x in other]))
        prior = best_bin_prior(*counts)
    return prior, _descend(*every, width, prior, p, total)


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, p: QualityParams = QualityParams()) -> QualityModel:
    """From rows of statistics; without a prior, it is estimated, every other row being of the first half."""
    model = QualityModel(0.5 if prior is None else prior)
    if not len(positive) or not len(unlabelled):
        return model
    model.edges = _edges(list(_cells(np.concatenate([positive, unlabelled]))), p)
    halves = ([x[0::2], x[1::2]] for x in (model.binned(positive), model.binned(unlabelled)))
    model.learned(*_learn(*halves, model.width, prior, p))
    return model


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at once, as a barrier stage counts them."""
    sc = spark.sparkContext._jsc.sc()
    return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def _received(peer: socket.socket, n: int) -> bytes:
    out = bytearray()
    while len(out) < n:
        part = peer.recv(n - len(out))
        if not part:
            raise ConnectionError("a task of the stage ended early")
        out += part
    return bytes(out)


@contextlib.contextmanager
def _summing(task: BarrierTaskContext) -> Iterator[Callable]:
    """A function that adds up an array of integers over the stage's tasks: the first task receives, adds
    and sends back. (Spark's own allGather takes about a second a call; here it tells the address.)"""
    infos, first = task.getTaskInfos(), task.partitionId() == 0
    with contextlib.ExitStack() as open_:
        host = infos[0].address.rsplit(":", 1)[0]
        told = ""
        if first:
            server = open_.enter_context(socket.create_server(("", 0), backlog=len(infos)))
            server.settimeout(WAIT_S)
            told = f"{server.getsockname()[1]} {secrets.token_hex(16)}"
        port, token = next(x for x in task.allGather(told) if x).split()
        peers = []
        while first and len(peers) < len(infos) - 1:
            peer = open_.enter_context(server.accept()[0])
            peer.settimeout(WAIT_S)
            with contextlib.suppress(OSError):
                if secrets.compare_digest(_received(peer, 32), token.encode()):
                    peers.append(peer)
        if not first:
            peers = [open_.enter_context(socket.create_connection((host, int(port)), WAIT_S))]
            peers[0].sendall(token.encode())
        for peer in peers:
            peer.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

        def total(sums: np.ndarray) -> np.ndarray:
            if not first:
                peers[0].sendall(sums.tobytes())
                return np.frombuffer(_received(peers[0], sums.nbytes), np.int64).reshape(sums.shape)
            for peer in peers:
                sums = sums + np.frombuffer(_received(peer, sums.nbytes), np.int64).reshape(sums.shape)
            for peer in peers:
                peer.sendall(sums.tobytes())
            return sums

        yield total


def _fit_rows(rows: DataFrame, n: int, prior: float | None, p: QualityParams) -> QualityModel:
    """fit_nnpu over a table of n rows: y (1 or -1), x, and unless the prior is given, later (of the second half)."""
    model = QualityModel(0.5 if prior is None else prior)
    counts = rows.select("x").mapInArrow(_cell_rows, "stat int, cell double, n long").groupBy("stat", "cell").agg(F.sum("n").alias("n")).toArrow()
    stat, cell, number = (counts.column(c).to_numpy() for c in ("stat", "cell", "n"))
    order = np.lexsort((cell, stat))
    ends = np.searchsorted(stat[order], np.arange(1, N_STATS))
    model.edges = _edges(list(zip(np.split(cell[order], ends), np.split(number[order], ends))), p)
    kind, width = np.dtype(np.uint8 if model.width <= 256 else np.uint16), model.width

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = model.binned(_matrix(b.column(1))).astype(kind)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), b.column(2)], ["y", "bins", "later"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {(k, later): [np.zeros((0, N_STATS), kind)] for k in (1, -1) for later in (False, True)}
        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), kind).reshape(-1, N_STATS)
            y, of_second = b.column(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            for k, later in held:
                held[k, later].append(x[(y == k) & (of_second == later)])
        positive, unlabelled = ([np.concatenate(held.pop((k, later))) for later in (False, True)] for k in (1, -1))
        task = BarrierTaskContext.get()
        with _summing(task) as total:
            found, theta = _learn(positive, unlabelled, width, prior, p, total)
        if task.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([found]), pa.array([theta.tolist()], pa.list_(pa.float64()))], ["prior", "theta"])

    tasks = min(_slots(rows.sparkSession), max(1, n // 4096))
    later = F.col("later") if "later" in rows.columns else F.lit(False)
    found = rows.select("y", "x", later.alias("later")).mapInArrow(bins, "y int, bins binary, later boolean").repartition(tasks).mapInArrow(descend, "prior double, theta array<double>", barrier=True).collect()
    model.learned(found[0].prior, np.array(found[0].theta))
    return model


def _docs(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(documents: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> QualityModel:
    docs = _docs(documents).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chosen = training_ids(labels, "quality", p.bound)
    # null where the row is labelled but not chosen
    marks = known.join(chosen, "doc_id", "left").select("doc_id", "y", F.lit(True).alias("known"))
    joined = docs.mapInArrow(_stats_of, "doc_id long, x array<double>").join(marks, "doc_id", "left")
    later = (F.xxhash64(F.lit("half"), "doc_id") % 2 != 0).alias("later")
    rows = materialise(joined.select(F.when(F.col("known"), F.col("y")).otherwise(-1).alias("y"), "x", later).where("y is not null"), "quality-statistics")
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    positive, negative, free = (n.get(y, 0) for y in (1, 0, -1))
    share = (positive + 1) / (positive + negative + 2)
    model = _fit_rows(rows.where("y <> 0"), positive + free, None, p) if positive and free else QualityModel(share)
    discard(rows)
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: QualityModel, at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in slices(batches):
        yield b, model.scores(np.array([statistics(t) for t in b.column(at).to_pylist()]))


def score_documents(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in _scored(batches, model, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    scored = _docs(documents).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is at least the threshold, with all their columns."""
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in _scored(batches, model, at):
            yield b.filter(pa.array(s >= threshold))

    return documents.mapInArrow(run, documents.schema)
