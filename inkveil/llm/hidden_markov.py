"""Language-model scores by a hidden Markov model over a corpus's own words.

Tokens are a text's words (lower-case ASCII) and one end. A state emits a class, a class emits a token: the
`own_classes` most frequent tokens are classes of their own, all others share `endings` classes by how they end,
and within a class a token's probability is its count plus 0.5 over the class's, with one slot for unseen tokens.
So the model's size is bounded while the counts behind it are those of every token of every training document.

1. Tokens are counted over all training documents; what is shuffled and joined grows with the corpus.
2. One pass turns each document into its classes; counts of the `near_tokens` most frequent tokens are broadcast (a
   bounded table), all other tokens are listed and meet their counts in a join.
3. Documents are cut into segments of `segment` tokens and laid out once, as a table of blocks: all first tokens of a
   block's segments, then all second ones, the longest segments first. Each round of Baum-Welch reads that table, a task
   runs forward-backward over its blocks and adds up expected transitions and emissions, and the sums of all tasks, dealt
   out by ranges of the model's cells, make the next model. The first guess is made from the class counts of the whole
   corpus, and all training documents take part in every round, whatever the corpus's size.
4. The scaled forward recursion gives the exact likelihood of each whole document, uncut.

A null or empty text is its end alone. With nothing to train on all counts are 0. Rows that repeat an id are scored
one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.rows import fold, most_frequent
from inkveil.llm.textbytes import LOWER, SPACED, U64, Spans, Words, chunks, signed
from inkveil.session import staged

CODED = "doc_id long, held_out boolean, n_tokens long, near_known long, near_logs double, classes binary, far array<bigint>"


@dataclass(frozen=True)
class MarkovParams:
    states: int = 8
    own_classes: int = 8192
    endings: int = 1024
    near_tokens: int = 1 << 19
    segment: int = 128
    #: Rounds of Baum-Welch, each over all training documents.
    rounds: int = 27
    #: Segments of one block, which forward-backward takes at once.
    block_segments: int = 1024
    #: Weight of the class frequencies that every state's emissions are smoothed with, in tokens.
    smoothing: float = 50.0
    #: Distinct tokens a task holds before it passes its counts on.
    held_tokens: int = 1 << 20
    seed: int = 5

    @property
    def classes(self) -> int:
        return 1 + self.own_classes + self.endings  # the end is class 0


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the most frequent tokens, the rank of each, and what is known of all."""

    keys: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    total: int
    distinct: int
    documents: int
    masses: np.ndarray  # of each class: its tokens' counts, 0.5 for each of them and 0.5 for unseen ones
    tokens: np.ndarray  # training tokens of each class


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # (2, states): of a document, and of a segment that goes on
    step: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states)


def token_words(column: pa.Array) -> Words:
    return Words(column, SPACED, LOWER)


def _endings(words: Words, at: np.ndarray, params: MarkovParams) -> np.ndarray:
    """The ending class of each word."""
    ends = words.ends[at]
    return (Spans(words.data, 9).of(np.maximum(ends - 3, words.starts[at]), ends) % U64(params.endings)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch], params: MarkovParams) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, first, at = np.unique(np.concatenate([k for k, _, _ in held]), return_index=True, return_inverse=True)
        counts = np.bincount(at, np.concatenate([n for _, n, _ in held]), len(keys)).astype(np.int64)
        return keys, counts, np.concatenate([e for _, _, e in held])[first]

    def batch(keys: np.ndarray, counts: np.ndarray, endings: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(endings), pa.array(counts)], ["h", "e", "c"])

    for rows in chunks(batches, "text"):
        words = token_words(rows.column("text"))
        keys, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
        held.append((keys, counts, _endings(words, first, params)))
        if sum(len(k) for k, _, _ in held) > 2 * params.held_tokens:
            held = [merged()]
            if len(held[0][0]) > params.held_tokens:
                yield batch(*held[0])
                held = []
    if held:
        yield batch(*merged())


def token_counts(train: DataFrame, params: MarkovParams = MarkovParams()) -> DataFrame:
    """(h, e, c): a token's hash, its ending class and how often it occurs in the training texts."""
    counted = train.select("text").mapInArrow(partial(_count, params=params), "h long, e int, c long")
    return counted.groupBy("h", "e").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, documents: int, params: MarkovParams) -> Vocabulary:
    near = most_frequent(counts, "c", params.near_tokens).toPandas()  # bounded by near_tokens
    near = near.sort_values(["c", "h"], ascending=[False, True])
    keys, count = near["h"].to_numpy(np.int64).view(U64), near["c"].to_numpy(np.int64)
    masses, tokens = np.full(params.classes, 0.5), np.zeros(params.classes)
    masses[0] += documents
    tokens[0] = documents
    own = min(params.own_classes, len(near))
    masses[1:1 + own] += count[:own] + 0.5
    tokens[1:1 + own] = count[:own]
    total = distinct = 0
    shared = 1 + params.own_classes
    for row in counts.groupBy("e").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # `endings` rows
        total, distinct = total + row.n, distinct + row.v
        masses[shared + row.e] += row.n + 0.5 * row.v
        tokens[shared + row.e] += row.n
    endings = near["e"].to_numpy(np.int64)[:own]
    np.subtract.at(masses, shared + endings, count[:own] + 0.5)
    np.subtract.at(tokens, shared + endings, count[:own])
    order = np.argsort(keys)
    return Vocabulary(keys[order], count[order], order, total + documents, distinct + (documents > 0), documents, masses, tokens)


def _classes(words: Words, vocab: Vocabulary, params: MarkovParams) -> tuple[np.ndarray, np.ndarray]:
    """Each word's class and its count, -1 where it isn't among the near tokens."""
    unique, at = np.unique(words.hashes, return_inverse=True)
    place = np.searchsorted(vocab.keys, unique)
    place[place == len(vocab.keys)] = 0
    near = vocab.keys[place] == unique if len(vocab.keys) else np.zeros(len(unique), bool)
    count = np.where(near, vocab.counts[place], -1) if len(vocab.keys) else np.full(len(unique), -1)
    # A token that isn't near has no class of its own, however few near ones there are.
    rank = np.where(near, vocab.ranks[place], params.own_classes) if len(vocab.keys) else np.full(len(unique), params.own_classes)
    other = 1 + params.own_classes + _endings(words, np.arange(len(words.starts)), params).astype(np.int64)
    return np.where(rank[at] < params.own_classes, 1 + rank[at], other), count[at]


def _code(batches: Iterator[pa.RecordBatch], vocab, params: MarkovParams) -> Iterator[pa.RecordBatch]:
    vocab = vocab.value
    end_log = np.log10(vocab.documents + 0.5)
    for rows in chunks(batches, "text"):
        words = token_words(rows.column("text"))
        kind, count = _classes(words, vocab, params)
        near = count >= 0
        logs = np.r_[0, np.cumsum(np.where(near, np.log10(np.maximum(count, 0) + 0.5), 0))]
        known = np.r_[0, np.cumsum(near)]
        a, b = words.firsts[:-1], words.firsts[1:]
        ends = np.insert(kind, b, 0).astype("<u2").tobytes()  # the end's class after each text's words
        cuts = (2 * (words.firsts + np.arange(len(words.firsts)))).tolist()
        far = np.flatnonzero(~near)
        far_cuts = np.searchsorted(far, words.firsts).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("held_out"), pa.array(words.counts + 1),
             pa.array(known[b] - known[a] + (vocab.documents > 0)), pa.array(logs[b] - logs[a] + end_log),
             pa.array([ends[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
             pa.ListArray.from_arrays(far_cuts, pa.array(signed(words.hashes[far])))],
            ["doc_id", "held_out", "n_tokens", "near_known", "near_logs", "classes", "far"])


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = column.to_pylist()
    firsts = np.r_[0, np.cumsum([len(x) // 2 for x in raw])].astype(np.int64)
    return np.frombuffer(b"".join(raw), "<u2").astype(np.int64), firsts


@dataclass(frozen=True)
class Block:
    """Segments laid out by time: all first tokens, then all second ones, and so on; the longest segments come first."""

    kinds: np.ndarray
    active: np.ndarray  # segments that have a first, a second ... token
    going: np.ndarray  # of each segment: whether it goes on within its document


def blocks(kinds: np.ndarray, firsts: np.ndarray, params: MarkovParams) -> Iterator[Block]:
    n = np.diff(firsts)
    parts = -(-n // params.segment)
    owner = np.repeat(np.arange(len(n)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = firsts[owner] + nth * params.segment
    size = np.minimum(params.segment, firsts[owner + 1] - first)
    order = np.argsort(-size, kind="stable")
    for at in range(0, len(order), params.block_segments):
        own = order[at:at + params.block_segments]
        active = np.searchsorted(-size[own], -np.arange(size[own[0]]), "left")
        by_time = np.concatenate([first[own[:m]] + t for t, m in enumerate(active.tolist())])
        yield Block(kinds[by_time], active, nth[own] > 0)


#: Steps between two scalings: within so few no probability leaves the range of single floats, as the likeliest state
#: of a class counts as 1 and no transition is less than one in the number of tokens.
SCALED = 4


class Counts:
    """Expected starts, transitions and emissions of blocks under a model, and the log likelihood, added up."""

    def __init__(self, model: Model, params: MarkovParams):
        self.top = model.emit.max(axis=1)
        self.start, self.step = model.start.astype(np.float32), model.step.astype(np.float32)
        self.back, self.emit = np.ascontiguousarray(self.step.T), (model.emit / self.top[:, None]).astype(np.float32)
        self.params = params
        self.starts, self.steps = np.zeros((2, params.states)), np.zeros((params.states, params.states))
        self.emissions, self.likelihood = np.zeros((params.classes, params.states)), 0.0

    def add(self, block: Block) -> None:
        """Scaled forward-backward; forward and backward share the scales, so their product is a probability as it is."""
        states = self.params.states
        kinds, active = block.kinds.astype(np.int64), [*block.active.tolist(), 0]
        cuts = np.r_[0, np.cumsum(active)].tolist()
        emitted = self.emit.take(kinds, axis=0)
        forward = np.empty_like(emitted)
        ones = np.ones(states, np.float32)
        for t, m in enumerate(active[:-1]):
            here = slice(cuts[t], cuts[t + 1])
            alpha = forward[here]
            if t == 0:
                np.multiply(self.start[block.going.astype(np.int64)], emitted[here], out=alpha)
            else:
                np.matmul(forward[cuts[t - 1]:cuts[t - 1] + m], self.step, out=alpha)
                alpha *= emitted[here]
            low = 0 if t % SCALED == SCALED - 1 else active[t + 1]  # segments that end here are scaled in any case
            if low < m:
                scale = np.maximum(alpha[low:] @ ones, np.float32(1e-37))
                self.likelihood += float(np.log(scale, dtype=np.float64).sum())
                np.reciprocal(scale, out=scale)
                alpha[low:] *= scale[:, None]
                emitted[cuts[t] + low:cuts[t + 1]] *= scale[:, None]
        backward = np.ones((active[-2] if len(active) > 1 else 0, states), np.float32)
        for t in range(len(active) - 2, 0, -1):
            here = slice(cuts[t], cuts[t + 1])
            ahead = emitted[here]
            ahead *= backward
            self.steps += forward[cuts[t - 1]:cuts[t - 1] + active[t]].T @ ahead
            forward[here] *= backward
            backward = np.ones((active[t - 1], states), np.float32)
            np.matmul(ahead, self.back, out=backward[:active[t]])
        forward[:active[0]] *= backward
        for s in range(states):
            self.emissions[:, s] += np.bincount(kinds, forward[:, s], self.params.classes)
        for going in (0, 1):
            self.starts[going] += forward[:active[0]][block.going == going].sum(axis=0, dtype=np.float64)

    def sums(self) -> tuple[Model, float]:
        seen = self.emissions.sum(axis=1)
        return Model(self.starts, self.steps * self.step, self.emissions), self.likelihood + float(seen @ np.log(self.top))


def expected(kinds: np.ndarray, firsts: np.ndarray, model: Model, params: MarkovParams) -> tuple[Model, float]:
    """Expected starts, transitions and emissions by forward-backward over segments, and the log likelihood of them."""
    counts = Counts(model, params)
    for block in blocks(kinds, firsts, params):
        counts.add(block)
    return counts.sums()


def improved(sums: Model, frequency: np.ndarray, params: MarkovParams) -> Model:
    emit = sums.emit + params.smoothing * frequency[:, None]
    return Model((sums.start + 1) / (sums.start + 1).sum(axis=1, keepdims=True),
                 (sums.step + 1) / (sums.step + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def first_guess(frequency: np.ndarray, params: MarkovParams) -> Model:
    rng = np.random.default_rng(params.seed)
    emit = frequency[:, None] * np.exp(rng.normal(0, 0.7, (params.classes, params.states)))
    step = np.full((params.states, params.states), 0.3 / params.states) + 0.7 * np.eye(params.states)
    return Model(np.full((2, params.states), 1 / params.states), step, emit / emit.sum(axis=0))


def _lay_out(batches: Iterator[pa.RecordBatch], params: MarkovParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "classes"):
        for block in blocks(*_sequences(rows.column("classes")), params):
            kinds, active, going = (x.astype(kind).tobytes() for x, kind in (
                (block.kinds, "<u2"), (block.active, "<i4"), (block.going, "?")))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (kinds, active, going)], ["kinds", "active", "going"])


#: Cells of the model that one row of sums holds.
CELLS = 1024


def _expect(batches: Iterator[pa.RecordBatch], model, params: MarkovParams) -> Iterator[pa.RecordBatch]:
    """This task's expected counts and log likelihood, cell by cell, in rows of `CELLS`."""
    counts = Counts(model.value, params)
    for batch in batches:
        for kinds, active, going in zip(*(batch.column(c).to_pylist() for c in ("kinds", "active", "going")), strict=True):
            counts.add(Block(np.frombuffer(kinds, "<u2"), np.frombuffer(active, "<i4"), np.frombuffer(going, "?")))
    sums, likelihood = counts.sums()
    cells = np.concatenate([sums.start.ravel(), sums.step.ravel(), sums.emit.ravel(), [likelihood]])
    rows = [cells[at:at + CELLS].astype("<f8").tobytes() for at in range(0, len(cells), CELLS)]
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(rows, pa.binary())], ["part", "cells"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
            own = np.frombuffer(cells, "<f8")
            found[part] = found[part] + own if part in found else own
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], ["part", "cells"])


def train(coded: DataFrame, frequency: np.ndarray, params: MarkovParams, seen: list[float] | None = None) -> Model:
    """Baum-Welch over all rows of `coded`; `seen` gets the log likelihood that each round starts from."""
    table = staged(coded.select("classes").mapInArrow(
        partial(_lay_out, params=params), "kinds binary, active binary, going binary"), "blocks")
    model, rows = first_guess(frequency, params), "part int, cells binary"
    for _ in range(params.rounds):
        sent = coded.sparkSession.sparkContext.broadcast(model)
        parts = table.mapInArrow(partial(_expect, model=sent, params=params), rows).repartition("part").mapInArrow(_added, rows)
        added = sorted((r.part, r.cells) for r in parts.collect())  # the model's cells, once
        cells = np.frombuffer(b"".join(c for _, c in added), "<f8")
        start, step, emit = np.split(cells[:-1], np.cumsum([model.start.size, model.step.size])) if len(cells) else (0, 0, 0)
        sums = Model(*(np.zeros(x.shape) + np.reshape(y, x.shape if np.size(y) > 1 else ()) for x, y in (
            (model.start, start), (model.step, step), (model.emit, emit))))
        if seen is not None and len(cells):
            seen.append(float(cells[-1]))
        model = improved(sums, frequency, params)
        sent.destroy()
    return model


def log10_likelihood(kinds: np.ndarray, firsts: np.ndarray, model: Model) -> np.ndarray:
    """log10 of each whole sequence's probability, by the scaled forward recursion."""
    n = np.diff(firsts)
    order = np.argsort(-n, kind="stable")
    first, left = firsts[order], n[order]
    found = np.zeros(len(n))
    alpha = None
    for t in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -t, "left"))
        alpha = (model.start[0] if t == 0 else alpha[:m] @ model.step) * model.emit[kinds[first[:m] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        found[:m] += np.log10(scale)
    result = np.empty(len(n))
    result[order] = found
    return result


def _likelihoods(batches: Iterator[pa.RecordBatch], model, masses: np.ndarray) -> Iterator[pa.RecordBatch]:
    logs = np.log10(masses)
    for rows in chunks(batches, "classes", 1 << 23):
        kinds, firsts = _sequences(rows.column("classes"))
        inside = np.r_[0, np.cumsum(logs[kinds])]
        score = log10_likelihood(kinds, firsts, model.value) - (inside[firsts[1:]] - inside[firsts[:-1]])
        names = ["r", "doc_id", "held_out", "n_tokens", "near_known", "near_logs"]
        yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(score)], [*names, "classes_log"])


def scores(docs: DataFrame, params: MarkovParams = MarkovParams()) -> DataFrame:
    """Per document the base score and the model's log10 probability; folds 0, 2, 3 and 4 of 5 are trained on."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (fold("doc_id", 5) == 1).alias("held_out"))
    train_rows = rows.where(~F.col("held_out"))
    counts = staged(token_counts(train_rows, params), "token-counts")
    vocab = vocabulary(counts, train_rows.count(), params)
    sent = context.broadcast(vocab)
    coded = rows.mapInArrow(partial(_code, vocab=sent, params=params), CODED).withColumn("r", F.monotonically_increasing_id())
    coded = staged(coded, "coded")

    frequency = (vocab.tokens + 0.5) / (vocab.tokens + 0.5).sum()
    model = context.broadcast(train(coded.where(~F.col("held_out")), frequency, params))

    scored = coded.select("r", "doc_id", "held_out", "n_tokens", "near_known", "near_logs", "classes").mapInArrow(
        partial(_likelihoods, model=model, masses=vocab.masses),
        "r long, doc_id long, held_out boolean, n_tokens long, near_known long, near_logs double, classes_log double")
    far = coded.select("r", F.explode("far").alias("h")).groupBy("r", "h").agg(F.count("*").alias("n"))
    far = far.join(counts.select("h", "c"), "h", "left").groupBy("r").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("far_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("far_logs"))
    logs = F.col("near_logs") + F.coalesce("far_logs", F.lit(0.0))
    base = float(np.log10(vocab.total + 0.5 * (vocab.distinct + 1)))
    return scored.join(far, "r", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("near_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), (logs - base * F.col("n_tokens")).alias("base_score"),
        (logs + F.col("classes_log")).alias("score"))
