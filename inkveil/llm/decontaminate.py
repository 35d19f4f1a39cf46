"""Benchmark decontamination by Wu-Manber search for many strings at once.

A document's words (lower-case ASCII; letters, digits and all other alphabets) are the text, the windows of ten
words of every benchmark item the patterns; an item of fewer words is one pattern of its own length. Patterns of
one length m make one search: a shift table over hashed blocks of three words says how far the end of the window
may move without passing an occurrence; where the shift is zero, the hash of the last words selects a bucket of
patterns, and their words are compared one by one.

The tables are made in blocks of at most `block_patterns` patterns, one on the driver and in a task at a time, so their
size is bounded whatever the benchmark's. One block, the usual case, is broadcast, and the documents are scanned once
and never shuffled. Of a larger benchmark each block has a scan of its own over the numbered documents, which are written
first; it writes the places and items it finds, a row a document with any, and these rows are merged by document.
Documents of one chunk are searched together, one step of all windows at a time, in stretches that overlap by a window.

Null and empty texts have no words and no hits. Rows that repeat an id are answered one by one. Repeated items
count as items of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.rows import NO_ID
from inkveil.llm.textbytes import ALPHANUMERIC, BASE, LOWER, U64, Words, chunks, mix, shingles, within
from inkveil.session import scratch_dir, staged

HITS = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, item_ids array<bigint>"


@dataclass(frozen=True)
class SearchParams:
    window_words: int = 10
    block_words: int = 3
    suffix_words: int = 5
    table_bits: int = 20
    #: Patterns of one broadcast block; more are further blocks.
    block_patterns: int = 1 << 20
    #: Words that one stretch of a document has.
    stretch: int = 512


@dataclass(frozen=True)
class Patterns:
    """The patterns of one length, and the items that have them."""

    words: np.ndarray  # (patterns, length) word hashes
    shift: np.ndarray  # by hashed block of words: how far the window's end may move
    suffixes: np.ndarray  # sorted hashes of the last words
    first: np.ndarray  # where each suffix's patterns begin; one more at the end
    members: np.ndarray  # patterns by suffix
    items: list[np.ndarray]  # item ids of each pattern

    @property
    def length(self) -> int:
        return self.words.shape[1]


def build(words: np.ndarray, items: list[np.ndarray], params: SearchParams) -> Patterns:
    m = words.shape[1]
    block, suffix = min(params.block_words, m), min(params.suffix_words, m)
    shift = np.full(1 << params.table_bits, m - block + 1, np.uint8)
    for end in range(block, m + 1):
        slot = _blocks(words[:, end - block:end], params)
        np.minimum.at(shift, slot, np.uint8(m - end))
    hashes = shingles_of_rows(words[:, m - suffix:])
    order = np.argsort(hashes, kind="stable")
    suffixes, first = np.unique(hashes[order], return_index=True)
    return Patterns(words, shift, suffixes, np.r_[first, len(order)], order, items)


def shingles_of_rows(words: np.ndarray) -> np.ndarray:
    found = words[:, 0].copy()
    for k in range(1, words.shape[1]):
        found = found * U64(BASE) + words[:, k]
    return mix(found)


def _blocks(words: np.ndarray, params: SearchParams) -> np.ndarray:
    return (shingles_of_rows(words) >> U64(64 - params.table_bits)).astype(np.int64)


def search(words: Words, patterns: Patterns, params: SearchParams) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence in the texts of `words`."""
    m = patterns.length
    block, suffix = min(params.block_words, m), min(params.suffix_words, m)
    hashes = words.hashes
    if len(hashes) < m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blocks = (shingles(hashes, block) >> U64(64 - params.table_bits)).astype(np.int64)
    endings = shingles(hashes, suffix)
    inside = within(words.firsts, m, len(hashes))
    # Stretches of each text: window starts from `at` up to `stop`.
    n_starts = np.maximum(words.counts - m + 1, 0)
    n_parts = -(-n_starts // params.stretch)
    owner = np.repeat(np.arange(words.n_texts), n_parts)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts)
    at = words.firsts[owner] + part * params.stretch
    stop = np.minimum(at + params.stretch, words.firsts[owner] + n_starts[owner])
    found_at, found_pattern = [], []
    while len(at):
        shift = patterns.shift[blocks[at + m - block]]
        maybe = at[shift == 0]
        if len(maybe):
            ending = endings[maybe + m - suffix]
            place = np.searchsorted(patterns.suffixes, ending)
            place[place == len(patterns.suffixes)] = 0
            known = patterns.suffixes[place] == ending
            maybe, place = maybe[known], place[known]
            n = patterns.first[place + 1] - patterns.first[place]
            starts = np.repeat(maybe, n)
            nth = np.arange(len(starts)) - np.repeat(np.cumsum(n) - n, n)
            which = patterns.members[np.repeat(patterns.first[place], n) + nth]
            same = inside[starts]
            for k in range(m):
                same[same] = hashes[starts[same] + k] == patterns.words[which[same], k]
            found_at.append(starts[same])
            found_pattern.append(which[same])
        at = at + np.maximum(shift, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    return np.concatenate(found_at or [np.zeros(0, np.int64)]), np.concatenate(found_pattern or [np.zeros(0, np.int64)])


def _item_windows(batches: Iterator[pa.RecordBatch], params: SearchParams) -> Iterator[pa.RecordBatch]:
    """(item_id, word hashes) of each window of an item."""
    for rows in chunks(batches, "text"):
        words = Words(rows.column("text"), ALPHANUMERIC, LOWER)
        owner, windows = [], []
        for i, (first, n) in enumerate(zip(words.firsts, words.counts, strict=False)):
            m = min(params.window_words, n)
            for k in range(n - m + 1 if n else 0):
                owner.append(i)
                windows.append(words.hashes[first + k:first + k + m].tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column("item_id").take(pa.array(owner, pa.int64())), pa.array(windows, pa.binary())], ["item_id", "window"])


def pattern_blocks(benchmark: DataFrame, params: SearchParams) -> Iterator[list[Patterns]]:
    """The distinct windows of all items, in blocks of a bounded size; one block is on the driver at a time."""
    windows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(
        partial(_item_windows, params=params), "item_id bigint, window binary")
    distinct = windows.groupBy("window").agg(F.sort_array(F.collect_set(F.coalesce("item_id", F.lit(NO_ID)))).alias("items"))
    rows: list[tuple[bytes, list[int]]] = []
    for row in distinct.toLocalIterator():
        rows.append((bytes(row.window), row["items"]))
        if len(rows) == params.block_patterns:
            yield _by_length(rows, params)
            rows = []
    if rows:
        yield _by_length(rows, params)


def _by_length(rows: list[tuple[bytes, list[int]]], params: SearchParams) -> list[Patterns]:
    found = []
    for size in sorted({len(w) for w, _ in rows}):
        same = [(w, i) for w, i in rows if len(w) == size]
        words = np.frombuffer(b"".join(w for w, _ in same), U64).reshape(len(same), size // 8)
        found.append(build(words, [np.array(i, np.int64) for _, i in same], params))
    return found


def _summary(words: Words, starts: np.ndarray, ends: np.ndarray, items: list[set[int]]) -> list[pa.Array]:
    """What is told of each text: its words, those between any start and end (word numbers of the chunk), its items."""
    marks = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    hit = np.r_[0, np.cumsum(np.cumsum(marks[:-1]) > 0)]
    n_hit = hit[words.firsts[1:]] - hit[words.firsts[:-1]]
    listed = [sorted(x) for x in items]
    named = [",".join(sorted("" if i == NO_ID else str(i) for i in x)) for x in listed]
    return [pa.array(words.counts), pa.array(n_hit), pa.array([len(x) for x in listed], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in named]), pa.array(n_hit > 0),
            pa.array(listed, pa.list_(pa.int64()))]


def _occurrences(words: Words, block: list[Patterns], params: SearchParams) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
    """First word and end of every occurrence, and the items of each text."""
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    items: list[set[int]] = [set() for _ in range(words.n_texts)]
    for patterns in block:
        at, which = search(words, patterns, params)
        starts.append(at)
        ends.append(at + patterns.length)
        for text, pattern in set(zip(words.text[at].tolist(), which.tolist(), strict=True)):
            items[text].update(patterns.items[pattern].tolist())
    return np.concatenate(starts), np.concatenate(ends), items


def _scan(batches: Iterator[pa.RecordBatch], block, params: SearchParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        words = Words(rows.column("text"), ALPHANUMERIC, LOWER)
        found = _summary(words, *_occurrences(words, block.value if block else [], params))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *found], [c.split()[0] for c in HITS.split(", ")])


def _places(batches: Iterator[pa.RecordBatch], block, params: SearchParams) -> Iterator[pa.RecordBatch]:
    """Starts and ends of occurrences (word numbers in the text) and items of each document that has a window of the block."""
    for rows in chunks(batches, "text"):
        words = Words(rows.column("text"), ALPHANUMERIC, LOWER)
        starts, ends, items = _occurrences(words, block.value, params)
        starts, ends = np.unique(np.stack([starts, ends]), axis=1)
        owner = words.text[starts]
        has = np.unique(owner)
        cuts = pa.array(np.r_[np.searchsorted(owner, has), len(owner)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x - words.firsts[owner])) for x in (starts, ends)]
        yield pa.RecordBatch.from_arrays(
            [rows.column("r").take(pa.array(has)), *lists, pa.array([sorted(items[i]) for i in has.tolist()], pa.list_(pa.int64()))],
            ["r", "starts", "ends", "items"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        words = Words(rows.column("text"), ALPHANUMERIC, LOWER)
        starts, ends = (np.concatenate([np.zeros(0, np.int64), *(
            words.firsts[i] + np.array(x, np.int64) for i, x in enumerate(rows.column(c).to_pylist()) if x)]) for c in ("starts", "ends"))
        items = [set(x or ()) for x in rows.column("items").to_pylist()]
        found = _summary(words, starts, ends, items)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *found], [c.split()[0] for c in HITS.split(", ")])


def _by_block(rows: DataFrame, blocks: Iterable[list[Patterns]], params: SearchParams) -> DataFrame:
    """(r, starts, ends, items) of the documents (r, text) with any window, from a scan for each block."""
    spark = rows.sparkSession
    folder, kind = scratch_dir(spark, "occurrences"), "r bigint, starts array<bigint>, ends array<bigint>, items array<bigint>"
    for block in blocks:
        sent = spark.sparkContext.broadcast(block)
        rows.select("r", "text").mapInArrow(partial(_places, block=sent, params=params), kind).write.mode("append").parquet(folder)
        sent.destroy()
    together = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")]
    return spark.read.schema(kind).parquet(folder).groupBy("r").agg(
        *together, F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """Per document its words, those inside a benchmark window, and the items whose windows occur."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = pattern_blocks(benchmark, params)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        sent = docs.sparkSession.sparkContext.broadcast(first) if first else None
        return rows.mapInArrow(partial(_scan, block=sent, params=params), HITS)
    rows = staged(rows.withColumn("r", F.monotonically_increasing_id()), "numbered")
    found = _by_block(rows, chain([first, second], blocks), params)
    return rows.join(found, "r", "left").select("doc_id", "text", "starts", "ends", "items").mapInArrow(_merged, HITS)


def _clean(batches: Iterator[pa.RecordBatch], block, params: SearchParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        words = Words(rows.column("text"), ALPHANUMERIC, LOWER)
        clean = np.ones(rows.num_rows, bool)
        for patterns in block.value:
            clean[words.text[search(words, patterns, params)[0]]] = False
        yield rows.filter(pa.array(clean))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """The documents without any benchmark window, as they are: a filter for each block, written between two blocks."""
    blocks = pattern_blocks(benchmark, params)
    kept, block = docs, next(blocks, None)
    while block is not None:
        sent = docs.sparkSession.sparkContext.broadcast(block)
        kept = kept.mapInArrow(partial(_clean, block=sent, params=params), docs.schema)
        block = next(blocks, None)
        if block is not None:
            kept = staged(kept, "uncontaminated")
            sent.destroy()
    return kept
