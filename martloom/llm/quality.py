"""Quality rules: a linear-chain conditional random field labels lines, Viterbi decodes them.

The field has two labels, boilerplate (0) and content (1). It is trained on a bounded
sample of labelled documents. Their lines take their document's label, but for lines of a bad
document that a good one has too; runs of a few lines of good and of bad documents are
joined to chains, so that the field learns what a change of label costs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .text import per_document, sampled_texts

#: Labelled documents of each quality that the field is trained on, at most.
SAMPLE = 400
#: Characters that the sample's texts hold together, at most.
SAMPLE_CHARS = 1 << 22
#: Lines of a run, chosen at random, and lines from which a training chain is long enough. None is left out.
RUNS, CHAIN = (1, 2, 4, 8), 40
#: Share of a document's words on content lines from which it is kept.
CONTENT_SHARE = 0.5

SYMBOLS = "#*$%&|<>"  # fixed value
SPACE = " \t\n\v\f\r"

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


def repeated_words(words: list) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, reached = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(reached, i)
            reached = i + 3
    return total


def line_features(line: str, words: list[str], repeated: bool) -> list[float]:
    chars = max(1, sum(map(len, words)))
    letters = max(1, sum(map(str.isalpha, line)))
    symbols = sum(map(line.count, SYMBOLS))
    return [
        1.0,
        symbols / chars,
        float(symbols > 2),
        sum(map(str.isupper, line)) / letters,
        line.count("!") / chars,
        sum(map(str.isdigit, line)) / chars,
        float(len(words) < 5),
        float(repeated),
        1.0 - len(set(words)) / len(words),
        float(words[-1][-1] in ".!?:;"),
        line.count("|") / len(words),
    ]


def lines_of(text: str) -> tuple[list[list[float]], list[int], int]:
    """Features and words of each line with a word, and the lines equal to an earlier one."""
    seen: set[str] = set()
    features, sizes, repeats = [], [], 0
    for line in text.split("\n"):
        words = line.encode("utf-8").split()
        if words:
            repeated = line in seen
            seen.add(line)
            repeats += repeated
            features.append(line_features(line, [w.decode() for w in words], repeated))
            sizes.append(len(words))
    return features, sizes, repeats


class LineField:
    """The trained field: ``weights`` score content against boilerplate, ``moves[a, b]`` a step from a to b."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray) -> None:
        self.weights, self.moves = weights, moves

    def decode(self, features: list[list[float]]) -> list[int]:
        """The likeliest labels of a document's lines."""
        scores = (np.asarray(features) @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        zero, one, back = 0.0, scores[0], []
        for s in scores[1:]:
            to0, to1 = zero + m00 < one + m10, zero + m01 < one + m11
            zero, one = (one + m10 if to0 else zero + m00), (one + m11 if to1 else zero + m01) + s
            back.append((to0, to1))
        label = int(one >= zero)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def training_chains(documents: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chains of runs of lines, in a fixed random order: features and labels of consecutive lines."""
    rng = np.random.default_rng(5)
    runs = []
    for x, labels in documents:
        at = 0
        while at < len(x):
            end = at + int(rng.choice(RUNS))
            runs.append((x[at:end], labels[at:end]))
            at = end
    chains, held, lines = [], [], 0
    for number in rng.permutation(len(runs)).tolist():
        held.append(runs[number])
        lines += len(held[-1][0])
        if lines >= CHAIN:
            chains.append(tuple(map(np.concatenate, zip(*held))))
            held, lines = [], 0
    if held:
        chains.append(tuple(map(np.concatenate, zip(*held))))
    return chains


def train_field(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.1) -> LineField:
    """Maximise the chains' conditional likelihood by gradient steps (Adam), with a small ridge.

    ``chains``: features and labels of consecutive lines. Without chains every line is content.
    """
    width = len(line_features("a", ["a"], False))
    if not chains:
        return LineField(np.eye(width)[0], np.zeros((2, 2)))
    longest, n = max(len(x) for x, _ in chains), len(chains)
    x, there, gold = np.zeros((n, longest, width)), np.zeros((n, longest)), np.zeros((n, longest))
    for i, (lines, labels) in enumerate(chains):
        x[i, : len(lines)], there[i, : len(lines)], gold[i, : len(lines)] = lines, 1.0, labels
    last = there.sum(axis=1).astype(int) - 1
    stepped = there[:, 1:]
    actual = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & (stepped > 0)).sum() for b in (0, 1)] for a in (0, 1)])
    theta = np.zeros(width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        moves = theta[width:].reshape(2, 2)
        node = np.stack([np.zeros((n, longest)), x @ theta[:width]], axis=2)
        forward, backward = np.zeros_like(node), np.zeros_like(node)
        forward[:, 0] = node[:, 0]
        for t in range(1, longest):
            reach = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + node[:, t]
            forward[:, t] = np.where(there[:, t, None] > 0, reach, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            reach = np.logaddexp.reduce(moves + (node[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(there[:, t + 1, None] > 0, reach, 0.0)
        total = np.logaddexp.reduce(forward[np.arange(n), last], axis=1)
        content = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]) * there
        gradient = np.einsum("nt,ntf->f", gold * there - content, x)
        pair = forward[:, :-1, :, None] + moves + (node[:, 1:] + backward[:, 1:])[:, :, None, :]
        expected = np.exp(pair - total[:, None, None, None]) * stepped[:, :, None, None]
        gradient = np.concatenate([gradient, (actual - expected.sum(axis=(0, 1))).ravel()]) / n - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LineField(theta[:width], theta[width:].reshape(2, 2))


def fit_line_field(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineField:
    """Train on at most ``sample`` labelled documents of each quality, as ``sampled_texts`` takes them."""

    def lines(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            flat = [np.asarray(lines_of(text)[0], dtype=np.float32).tobytes() for text in texts]
            marks = [[xxhash.xxh64(line).digest() for line in text.split("\n") if line.encode("utf-8").split()] for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(flat, pa.binary()), pa.array(map(b"".join, marks), pa.binary())], ["quality", "lines", "marks"]
            )

    labelled = sampled_texts(docs, labels, "quality", sample, SAMPLE_CHARS).select("quality", "text")
    width = len(line_features("a", ["a"], False))
    rows = sorted((r["quality"], r["marks"], r["lines"]) for r in labelled.mapInArrow(lines, "quality int, lines binary, marks binary").collect())
    marked = [np.frombuffer(marks, dtype=np.uint64) for _, marks, _ in rows]
    of_good = np.unique(np.concatenate([m for (q, _, _), m in zip(rows, marked) if q] or [np.zeros(0, dtype=np.uint64)]))
    documents = [
        (np.frombuffer(flat, dtype=np.float32).reshape(-1, width).astype(float), np.isin(m, of_good).astype(float))
        for (_, _, flat), m in zip(rows, marked)
    ]
    return train_field(training_chains(documents))


def judge(field: LineField, share: float = CONTENT_SHARE) -> Callable[[str], tuple]:
    """The measures of a text and the verdict, in the order of ``RESULT``."""

    def measures(text: str) -> tuple:
        words = text.encode("utf-8").split()
        features, sizes, repeated_lines = lines_of(text)
        repeated = repeated_words(words)
        failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
        content = 0.0
        if features:
            labels = field.decode(features)
            content = sum(n for n, label in zip(sizes, labels) if label) / len(words)
        return (
            len(words),
            len(text) - sum(map(text.count, SPACE)),
            sum(map(text.count, SYMBOLS)),
            repeated_lines,
            repeated,
            failed,
            content,
            not failed and content >= share,
        )

    return measures


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and ``RESULT`` for every row of ``docs``; a null or empty text has no words and fails."""
    return per_document(docs, RESULT, judge(fit_line_field(docs, labels)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were.

    Every row is judged by its own text: repeated rows stay or go together, ids may be null, and null, empty and
    blank texts have no words and go. Without labels every line counts as content, so the base rules decide.
    """
    verdict = judge(fit_line_field(docs, labels))
    columns, schema = docs.columns, docs.schema

    def good(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(columns.index("text")).to_pylist()
            yield batch.filter(pa.array([verdict(text or "")[-1] for text in texts], pa.bool_()))

    return docs.mapInArrow(good, schema)


