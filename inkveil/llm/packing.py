"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents become pieces of at most `capacity` tokens (only longer ones are cut; the first piece takes the
remainder) and sequences of that capacity are filled with whole pieces.

1. Pieces are range-sorted by length, ids only; a piece's rank among those of its length comes from the counts of the
   ranges before its own, so a length that a third of all pieces has is spread like any other.
2. Pieces of one length are alike, and so are gaps of one size: a round works on runs of ranks, at most as many
   lengths as the capacity, never on rows. Each round sweeps all sizes upwards: every gap takes the longest
   piece that fits (each piece proposes to its successor, the smallest gap that holds it; where more propose than
   there are gaps, the higher rank, that is the longer piece, wins and the others move on to the next gap). Then the
   gaps are updated and the next round begins. A sequence is opened only for a piece that no gap holds.
3. The runs say for any (length, rank) which sequence and offset it has; every piece looks its own up in its task.

The number of runs is bounded by rounds and capacity, not by the corpus: doubling the corpus doubles their counts.

A null or empty text is its end token alone. Rows that repeat an id are packed one by one, ranked among each other
by what else they have; their pieces keep the same names.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkveil.llm.textbytes import chunks, texts
from inkveil.session import staged

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class PackParams:
    capacity: int = 1024
    end_id: int = 2
    #: The vocabulary as ranks for tiktoken and the split pattern; both of the byte-level vocabulary of 50,257 ids.
    vocabulary: str | None = None
    #: Rows of one range of the sort.
    range_rows: int = 1 << 20


@cache
def _encoding(vocabulary: str | None):
    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens are matched as they are, without regard to what is around them")
    special = {token["content"]: token["id"] for token in added}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(text: str, params: PackParams = PackParams()) -> np.ndarray:
    """The ids of a text, its end token included. The vocabulary's added tokens are found inside the text."""
    ids = _encoding(params.vocabulary).encode(text, allowed_special="all")
    ids.append(params.end_id)
    return np.array(ids, np.uint32)


def _pieces(batches: Iterator[pa.RecordBatch], params: PackParams) -> Iterator[pa.RecordBatch]:
    size = params.capacity
    for rows in chunks(batches, "text"):
        out: list[list[int]] = [[], [], [], [], []]
        for row, text in enumerate(texts(rows.column("text"))):
            ids = encode(text, params)
            first = len(ids) % size or size
            cuts = [0, *range(first, len(ids) + 1, size)]
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                for column, value in zip(out, (row, n, a, b - a, zlib.crc32(raw[4 * a:4 * b])), strict=True):
                    column.append(value)
        owner, n, a, length, crc = out
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(n, pa.int32()), pa.array(a, pa.int64()),
             pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(partial(_pieces, params=params), PIECES)


class Runs:
    """Runs [first, first + n) of alike things by size, taken from the front."""

    def __init__(self, capacity: int):
        self.held: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
        self.count = np.zeros(capacity + 1, np.int64)

    def add(self, size: int, first: int, n: int) -> None:
        if n:
            self.held[size].append([first, n])
            self.count[size] += n

    def take(self, size: int, n: int) -> list[tuple[int, int]]:
        taken = []
        self.count[size] -= n
        held = self.held[size]
        while n:
            first, have = held[-1]
            k = min(n, have)
            taken.append((first, k))
            if k == have:
                held.pop()
            else:
                held[-1] = [first + k, have - k]
            n -= k
        return taken


def matches(free: np.ndarray, gaps: np.ndarray) -> list[tuple[int, int, int]]:
    """(length, gap, n): one round's matches of pieces by length with gaps by size, one piece a gap.

    A sweep over sizes upwards: pieces wait for their successor gap, a gap takes the longest that waits.
    """
    found: list[tuple[int, int, int]] = []
    waiting: list[list[int]] = []
    for size in range(1, len(free)):
        if free[size]:
            waiting.append([size, int(free[size])])
        room = int(gaps[size])
        while room and waiting:
            length, n = waiting[-1]
            k = min(n, room)
            found.append((length, size, k))
            room -= k
            if k == n:
                waiting.pop()
            else:
                waiting[-1][1] = n - k
    return found


def plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (length, first rank, n, first sequence, offset): pieces of one length, rank by rank, in rank-aligned runs."""
    pieces_, gaps = Runs(capacity), Runs(capacity)
    for length in range(1, capacity + 1):
        pieces_.add(length, 0, int(counts[length]))
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, gap: int, n: int, targets: list[tuple[int, int]]) -> None:
        ranks = pieces_.take(length, n)
        while targets:
            (rank, a), (sequence, b) = ranks.pop(), targets.pop()
            k = min(a, b)
            rows.append((length, rank, k, sequence, capacity - gap))
            gaps.add(gap - length, sequence, k)
            if a > k:
                ranks.append((rank + k, a - k))
            if b > k:
                targets.append((sequence + k, b - k))

    while pieces_.count.any():
        longest = int(np.flatnonzero(pieces_.count)[-1])
        if not gaps.count[longest:].any():
            # No gap holds the longest pieces, nor any two of them one sequence if they are longer than half.
            n = int(pieces_.count[longest])
            n = n if 2 * longest > capacity else -(-n // (capacity // longest))
            place(longest, capacity, n, [(opened, n)])
            opened += n
            continue
        for length, gap, n in matches(pieces_.count, gaps.count):
            place(length, gap, n, gaps.take(gap, n))
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by length get their number among those of their length in this partition."""
    last, seen = -1, 0
    for rows in batches:
        lengths = rows.column("length").to_numpy()
        if not len(lengths):
            continue
        opens = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]])
        rank = np.arange(len(lengths)) - np.repeat(opens, np.diff(np.r_[opens, len(lengths)]))
        if lengths[0] == last:
            rank[:opens[1] if len(opens) > 1 else len(lengths)] += seen
        last, seen = int(lengths[-1]), int(rank[-1]) + 1
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(rank)], [*rows.schema.names, "rank"])


def _looked_up(batches: Iterator[pa.RecordBatch], runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = runs[:, 0] << 48 | runs[:, 1] if len(runs) else np.zeros(0, np.int64)
    for rows in batches:
        lengths, rank = rows.column("length").to_numpy(), rows.column("rank").to_numpy()
        at = np.searchsorted(keys, lengths << 48 | rank, "right") - 1
        sequence = runs[at, 3] + rank - runs[at, 1]
        columns = [rows.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(sequence), pa.array(runs[at, 4])],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def packed(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """One row per piece with its sequence and its place in it."""
    cut = staged(pieces(docs, params), "pieces")
    ranges = max(1, -(-cut.count() // params.range_rows))
    ordered = cut.repartitionByRange(ranges, "length", "ids_crc32", "doc_id", "piece").sortWithinPartitions("length")
    numbered = staged(
        ordered.mapInArrow(_ranked, PIECES + ", rank bigint").withColumn("part", F.spark_partition_id()), "ranks")
    # A range holds whole lengths but for its first and last, so these counts are as few as lengths and ranges.
    counts = numbered.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = np.zeros(params.capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        totals[row["length"]] = row["n"]
    runs = docs.sparkSession.sparkContext.broadcast(plan(totals, params.capacity))
    ranked = numbered.join(before.drop("n"), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.select(*[c.strip().split()[0] for c in PIECES.split(",")], "rank").mapInArrow(
        lambda batches: _looked_up(batches, runs.value), PLACED)
