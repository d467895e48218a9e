"""Toxicity by a factorization machine over hashed terms.

Terms are words, word beginnings, and beginnings that several different words of a
text share, hashed to buckets; a text is the set of its buckets. Besides a weight each
bucket has factors, whose products score pairs of terms in one text. Trained here on a bounded
sample of labelled rows: every bucket that is not rare takes part, and those whose own gradient,
and whose gradient together with the rest of a text, stay within the noise end up with zeros.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import per_document, sampled_texts

RESULT = "held_out boolean, score double, predicted int"

#: Labelled documents of each class that the machine is trained on, at most.
SAMPLE = 5000
#: Characters that the sample's texts hold together, at most.
SAMPLE_CHARS = 1 << 25
BUCKETS, FACTORS = 1 << 18, 4
#: Texts of the sample that a bucket must be in, alone and for its pairs to be looked at.
FLOOR, PAIR_FLOOR = 3, 10
#: Gradients count from so many standard deviations of chance on: a bucket's own, and that of its pairs.
NOISE, PAIR_NOISE = 1.25, 5.0
#: Word beginnings that are terms too, by length.
STEMS = (4, 5, 6)
#: A beginning is another term if this many different words share it.
SHARED_BY = (2, 3, 5)
FOLDS = 5

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


class TermBuckets:
    """The buckets of a text's terms, as sorted distinct numbers; remembers words, within bounds."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        return TermBuckets, ()

    def of_word(self, word: str) -> tuple[int, ...]:
        done = self.known.get(word)
        if done is None:
            terms = [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]
            done = tuple(zlib.crc32(t.encode()) % BUCKETS for t in terms)
            if len(self.known) >= 300_000:
                self.known.clear()
            if len(word) < 60:
                self.known[word] = done
        return done

    def __call__(self, text: str) -> np.ndarray:
        lowered = text.lower() if text.isascii() else text.translate(_LOWER)
        words = set(WORD.findall(lowered))
        buckets, words_of = np.unique(
            np.fromiter((b for w in words for b in self.of_word(w)), dtype=np.int64), return_counts=True
        )
        shared = [(buckets[words_of >= n] * 40503 + n) % BUCKETS for n in SHARED_BY]
        return np.unique(np.concatenate([buckets, *shared]))


class FactorizationMachine:
    """Weights and factors of the chosen buckets; ``place`` maps buckets to them, -1 elsewhere."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray) -> None:
        self.place = np.full(BUCKETS, -1, dtype=np.int32)
        self.place[buckets] = np.arange(len(buckets))
        self.bias, self.weights, self.factors = bias, weights, factors

    def score(self, buckets: np.ndarray) -> float:
        at = self.place[buckets]
        at = at[at >= 0]
        v = self.factors[at]
        total = v.sum(axis=0)
        z = self.bias + self.weights[at].sum() + 0.5 * float((total**2 - (v**2).sum(axis=0)).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0))))


class SparseRows:
    """Rows of zeros and ones: columns ``at`` of ``row``, sorted by row."""

    def __init__(self, rows: list[np.ndarray], columns: np.ndarray) -> None:
        place = np.full(BUCKETS, -1, dtype=np.int64)
        place[columns] = np.arange(len(columns))
        self.shape = len(rows), len(columns)
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        at = place[np.concatenate(rows)] if len(rows) else np.zeros(0, dtype=np.int64)
        row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        self.at, self.row = at[at >= 0].astype(np.int32), row[at >= 0]

    def only(self, columns: np.ndarray) -> SparseRows:
        """The rows with these columns alone, numbered anew."""
        place = np.full(self.shape[1], -1, dtype=np.int32)
        place[columns] = np.arange(len(columns))
        part = SparseRows([], columns[:0])
        kept = place[self.at] >= 0
        part.shape, part.at, part.row = (self.shape[0], len(columns)), place[self.at[kept]], self.row[kept]
        return part

    def times(self, v: np.ndarray) -> np.ndarray:
        """The product with a vector."""
        return np.bincount(self.row, weights=v[self.at], minlength=self.shape[0])

    def turned_times(self, g: np.ndarray) -> np.ndarray:
        """The product of the transpose with a vector."""
        return np.bincount(self.at, weights=g[self.row], minlength=self.shape[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sparse_weights(x: SparseRows, y: np.ndarray, importance: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and the columns' means of a logistic model whose weights within the noise are exactly zero.

    Columns are centred and scaled to equal spread, so that one threshold, ``NOISE`` standard deviations of
    a gradient without any effect, holds for all. Steps are taken on the columns beyond the threshold; then all
    others are looked at again, until none of them has come to be beyond it.
    """
    mean = x.turned_times(importance)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    share = float((importance * y).sum())
    noise = NOISE * float(np.sqrt((importance**2 * (y - share) ** 2).sum()))
    bias, w = float(np.log((share + 1e-4) / (1 - share + 1e-4))), np.zeros(x.shape[1])
    taking_part = np.zeros(x.shape[1], dtype=bool)
    for _ in range(10):
        u = w / spread
        g = (_sigmoid(bias + x.times(u) - (u * mean).sum()) - y) * importance
        beyond = (np.abs(x.turned_times(g) - mean * g.sum()) / spread > noise * 1.01) & ~taking_part
        if not beyond.any():
            break
        taking_part |= beyond
        some = np.flatnonzero(taking_part)
        bias, w[some] = _proximal_steps(x.only(some), y, importance, mean[some], spread[some], noise, bias, w[some])
    return bias, w / spread, mean


def _proximal_steps(
    x: SparseRows, y: np.ndarray, importance: np.ndarray, mean: np.ndarray, spread: np.ndarray, noise: float, bias: float, w: np.ndarray, rounds: int = 120
) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient steps from ``bias`` and ``w``, the weights of the scaled columns."""

    def forward(u: np.ndarray) -> np.ndarray:
        return x.times(u / spread) - (u / spread * mean).sum()

    def backward(g: np.ndarray) -> np.ndarray:
        return (x.turned_times(g) - mean * g.sum()) / spread

    direction, steepest = np.random.default_rng(0).standard_normal(x.shape[1]), 1.0
    for _ in range(12):
        direction = backward(importance * forward(direction))
        steepest = max(float(np.linalg.norm(direction)), 1e-12)
        direction /= steepest
    step = 3.6 / steepest  # the curvature of the loss is a quarter of that at most
    ahead, pace = w, 1.0
    for _ in range(rounds):
        g = (_sigmoid(bias + forward(ahead)) - y) * importance
        moved = ahead - step * backward(g)
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * noise, 0)
        bias -= 2 * float(g.sum())
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / faster * (moved - w)
        w, pace = moved, faster
    return bias, w


def paired_columns(x: SparseRows, y: np.ndarray, importance: np.ndarray, bias: float, w: np.ndarray, mean: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Columns that change what the weighted terms of a text mean: their gradient as partners of the text's own score.

    Such a column may be as frequent in both classes, like a group that insults mention and others too.
    """
    own = x.times(w) - (w * mean).sum()
    pull = (_sigmoid(bias + own) - y) * importance * (own - (importance * own).sum())
    gradient = x.turned_times(pull) - mean * pull.sum()
    chance = np.sqrt(np.maximum(mean * (1 - mean), 1e-9) * (pull**2).sum())
    return np.flatnonzero((np.abs(gradient) > PAIR_NOISE * np.maximum(chance, 1e-15)) & (counts >= PAIR_FLOOR))


def train_machine(
    rows: list[np.ndarray], toxic: np.ndarray, share: float, rounds: int = 150, rate: float = 0.1
) -> FactorizationMachine:
    """Fit by gradient steps (Adam) with a ridge; ``share`` of toxic rows is what the scores are set to.

    Which buckets get weights and factors is decided by ``sparse_weights`` and ``paired_columns`` over all
    buckets of ``FLOOR`` rows or more; their number has no limit.
    """
    y = toxic.astype(float)
    ones = max(1.0, float(y.sum()))
    zeros = max(1.0, float(len(y) - y.sum()))
    importance = np.where(y > 0, share / ones, (1 - share) / zeros)
    counts = np.bincount(np.concatenate(rows), minlength=BUCKETS) if len(rows) else np.zeros(BUCKETS, dtype=np.int64)
    buckets = np.flatnonzero(counts >= FLOOR)
    if len(buckets):
        x = SparseRows(rows, buckets)
        bias, w, mean = sparse_weights(x, y, importance)
        pairs = paired_columns(x, y, importance, bias, w, mean, counts[buckets])
        buckets = buckets[np.union1d(np.flatnonzero(w), pairs)]
    width = len(buckets)
    x = SparseRows(rows, buckets)
    rng = np.random.default_rng(7)
    bias = float(np.log((share + 1e-4) / (1 - share + 1e-4)))
    theta = np.concatenate([[bias], np.zeros(width), 0.01 * rng.standard_normal(width * FACTORS)])
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    ridge = np.concatenate([[0.0], np.full(width, 1e-5), np.full(width * FACTORS, 1e-4)])
    for step in range(1, rounds + 1):
        w, v = theta[1 : 1 + width], theta[1 + width :].reshape(width, FACTORS)
        sums = np.stack([x.times(v[:, f]) for f in range(FACTORS)], axis=1)
        z = theta[0] + x.times(w) + 0.5 * ((sums**2).sum(axis=1) - x.times((v**2).sum(axis=1)))
        g = (_sigmoid(z) - y) * importance
        pulled = x.turned_times(g)
        dv = np.stack([x.turned_times(g * sums[:, f]) for f in range(FACTORS)], axis=1) - v * pulled[:, None]
        gradient = np.concatenate([[g.sum()], pulled, dv.ravel()]) + ridge * theta
        m, s = 0.9 * m + 0.1 * gradient, 0.99 * s + 0.01 * gradient**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return FactorizationMachine(buckets, float(theta[0]), theta[1 : 1 + width], theta[1 + width :].reshape(width, FACTORS))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorizationMachine:
    """Train on at most ``sample`` labelled ids of each class outside the held-out fold, as ``sampled_texts`` takes them."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sizes = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    terms = TermBuckets()

    def rows(batches):
        for batch in batches:
            found = [terms(text or "").astype("<i4").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.binary())], ["toxic", "terms"])

    known = sampled_texts(docs, usable, "toxic", sample, SAMPLE_CHARS).select("toxic", "text")
    held = sorted((row["toxic"], row["terms"]) for row in known.mapInArrow(rows, "toxic int, terms binary").collect())
    toxic = np.array([label for label, _ in held], dtype=np.int64)
    return train_machine([np.frombuffer(t, dtype="<i4").astype(np.int64) for _, t in held], toxic, share)


def scorer(machine: FactorizationMachine) -> Callable[[str], float]:
    terms = TermBuckets()
    return lambda text: machine.score(terms(text))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and ``RESULT`` for every row of ``docs``.

    A null or empty text has no terms and the bias for a score. Held out are the ids
    whose crc32 is divisible by 5; a null id is not.
    """
    score = scorer(fit_toxicity(docs, labels))
    scored = per_document(docs, "score double", lambda text: (score(text),))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
