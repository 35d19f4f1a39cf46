"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad; its evidence are its own features and those of the lines beside it, and a transition
weight ties neighbouring labels. Forward-backward gives each line's marginal probability of being good; a document's
score is the mean of its lines' marginals, weighted by length. Training lines carry the label of their document.

Training uses at most `max_labelled` labelled rows (the least by a hash of the id, copies of a text once), whose line
features come to the driver; scoring is one scan of all documents, without a shuffle, in chunks of bounded size.

A null or empty text is one empty line and has a score like any other. Without labels of both kinds the score is the
share of good labels (1 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.rows import fold
from inkveil.llm.textbytes import SPACED, Words, buffers, chunks, line_spans
from inkveil.llm.toxicity import labelled


@dataclass(frozen=True)
class QualityParams:
    max_labelled: int = 4000
    steps: int = 100
    rate: float = 0.15
    penalty: float = 1e-3
    threshold: float = 0.3


def _flags(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[[*characters]] = True
    return found


_CLASSES = (
    _flags(bytes(range(65, 91))),  # capitals
    _flags(bytes(range(48, 58))),
    _flags(b"#*$%&|<>"),
    _flags(b"!?"),
    _flags(b".,;:'\"()-"),
    _flags(bytes(range(128, 256))),
)
BINS = ((0, 0.3), (1, 0.2), (2, 0.02), (2, 0.15), (3, 0.05), (7, 0.2), (8, 0.3))
OWN = len(_CLASSES) + 6
WIDTH = 1 + (OWN + len(BINS)) * 3


@dataclass(frozen=True)
class Lines:
    x: np.ndarray  # (lines, features)
    weight: np.ndarray  # bytes of the line and its end
    firsts: np.ndarray  # each text's first line; one more at the end


def lines_of(column: pa.Array) -> Lines:
    data, offsets = buffers(column)
    start, stop, _, firsts = line_spans(data, offsets)
    size = np.maximum(stop - start, 1)

    def counted(flags: np.ndarray, low: np.ndarray = start, high: np.ndarray = stop) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags)]
        return sums[high] - sums[low]

    words = Words(column, SPACED)
    line = np.searchsorted(stop, words.starts, "right")  # of words; empty lines end before any word starts
    n = np.bincount(line, minlength=len(stop))[:len(stop)]
    per = np.maximum(n, 1)
    again = np.zeros(len(words.hashes), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (line[1:] == line[:-1])
    by_line = np.lexsort((words.hashes, line))
    seen = np.zeros(len(again), bool)
    same = (words.hashes[by_line][1:] == words.hashes[by_line][:-1]) & (line[by_line][1:] == line[by_line][:-1])
    seen[1:] = same
    repeats = np.bincount(line[by_line], seen, len(stop))[:len(stop)]
    own = np.stack([
        *(counted(c[data]) / size for c in _CLASSES), np.log1p(stop - start) / 5, np.bincount(line, again, len(stop))[:len(stop)] / per,
        repeats / per, np.where(n > 0, counted(SPACED[data]) / per, 0) / 10, n == 0, n == 1], axis=1).astype(float)
    own = np.concatenate([own, np.stack([own[:, j] > cut for j, cut in BINS], axis=1)], axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[firsts[:-1]] = 0
    after[firsts[1:] - 1] = 0
    return Lines(np.concatenate([np.ones((len(own), 1)), own, before, after], axis=1), stop - start + 1, firsts)


def marginals(score: np.ndarray, transition: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every line the probability of (bad, good), and the expected transitions of all lines, by forward-backward.

    `score` are the log potentials of good against bad; all texts go a line at a time, the longest first.
    """
    n = np.diff(firsts)
    order = np.argsort(-n, kind="stable")
    first, left = firsts[order], n[order]
    node = np.stack([np.zeros(len(score)), score], axis=1)
    node = np.exp(node - node.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    forward, backward = np.zeros_like(node), np.ones_like(node)
    longest = int(left[0]) if len(left) else 0
    active = [int(np.searchsorted(-left, -t, "left")) for t in range(longest)]  # texts of more than t lines
    for t in range(longest):
        at = first[:active[t]] + t
        alpha = node[at] if t == 0 else (forward[at - 1] @ step) * node[at]
        forward[at] = alpha / alpha.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[:active[t + 1]] + t
        ahead = node[at + 1] * backward[at + 1]
        beta = ahead @ step.T
        joint = forward[at][:, :, None] * step * ahead[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        backward[at] = beta / beta.sum(axis=1, keepdims=True)
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True), pairs


@dataclass(frozen=True)
class Field:
    """Feature weights (already for unscaled features), transitions, and the share of good labels where nothing was learned."""

    weights: np.ndarray
    transition: np.ndarray
    share: float | None = None

    def score(self, lines: Lines) -> np.ndarray:
        if self.share is not None:
            return np.full(len(lines.firsts) - 1, self.share)
        good = marginals(lines.x @ self.weights, self.transition, lines.firsts)[0][:, 1]
        total = np.add.reduceat(good * lines.weight, lines.firsts[:-1]) if len(lines.firsts) > 1 else np.zeros(0)
        return np.clip(total / np.add.reduceat(lines.weight, lines.firsts[:-1]), 0, 1) if len(total) else total


def fit_field(lines: Lines, good: np.ndarray, params: QualityParams) -> Field:
    """Conditional likelihood by Adam over scaled features; each text weighs the same."""
    n = np.diff(lines.firsts)
    if not len(good) or good.min() == good.max():
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), float(good.mean()) if len(good) else 1.0)
    scale = np.maximum(lines.x.std(axis=0), 1e-3)
    scale[0] = 1
    x = lines.x / scale
    y = np.repeat(good, n).astype(float)
    seen = np.array([[((good == 0) * (n - 1)).sum(), 0], [0, ((good == 1) * (n - 1)).sum()]], float)
    values = np.zeros(WIDTH + 4)
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for t in range(1, params.steps + 1):
        p, pairs = marginals(x @ values[:WIDTH], values[WIDTH:].reshape(2, 2), lines.firsts)
        slope = np.r_[(y - p[:, 1]) @ x, (seen - pairs).ravel()] / len(y) - params.penalty * values
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        values += params.rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Field(values[:WIDTH] / scale, values[WIDTH:].reshape(2, 2))


def _training_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        lines = lines_of(rows.column("text"))
        raw = lines.x.astype(np.float32)
        cuts = lines.firsts.tolist()
        yield pa.RecordBatch.from_arrays(
            [rows.column("label"), pa.array([raw[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
            ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> Field:
    sample = labelled(docs, labels, "quality", params)
    rows = sorted((bytes(r.x), r.label) for r in sample.mapInArrow(_training_lines, "label int, x binary").toLocalIterator())
    x = [np.frombuffer(raw, np.float32).reshape(-1, WIDTH) for raw, _ in rows]
    firsts = np.r_[0, np.cumsum([len(a) for a in x])].astype(np.int64)
    joined = np.concatenate(x).astype(float) if x else np.zeros((0, WIDTH))
    return fit_field(Lines(joined, np.ones(len(joined)), firsts), np.array([y for _, y in rows]), params)


def _score(batches: Iterator[pa.RecordBatch], field, params: QualityParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        lines = lines_of(rows.column("text"))
        score = field.value.score(lines)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array((score >= params.threshold).astype(np.int32)),
             pa.array(np.diff(lines.firsts))], ["doc_id", "held_out", "score", "predicted", "n_lines"])


def scores(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Per document its quality from 0 to 1, and whether it is at the threshold or above."""
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return rows.mapInArrow(partial(_score, field=field, params=params),
                           "doc_id long, held_out boolean, score double, predicted int, n_lines long")


def _line_labels(batches: Iterator[pa.RecordBatch], field) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        lines = lines_of(rows.column("text"))
        model = field.value
        good = (np.full(len(lines.x), model.share) if model.share is not None
                else marginals(lines.x @ model.weights, model.transition, lines.firsts)[0][:, 1])
        owner = np.repeat(np.arange(rows.num_rows), np.diff(lines.firsts))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(pa.array(owner)), pa.array(np.arange(len(owner)) - lines.firsts[owner]), pa.array(good),
             pa.array(good >= 0.5)], ["doc_id", "line", "good", "kept"])


def line_labels(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Every line's number, its marginal probability of being good, and its label."""
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        partial(_line_labels, field=field), "doc_id long, line long, good double, kept boolean")
