"""Whole columns of text as bytes: words, hashes and counts of many texts at once in numpy.

A batch is cut into chunks of about `CHUNK` bytes before anything is computed, so a task's memory is a small
multiple of the chunk, or of one text where a single text is longer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.ones(256, bool)
    for low, high in ranges:
        found[low:high + 1] = False
    return found


#: Bytes of words that white space separates, and of words of letters and digits (bytes of other alphabets included).
SPACED = _mask((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = _mask((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = np.where((AS_IS >= 65) & (AS_IS <= 90), AS_IS + 32, AS_IS).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@cache
def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=U64)


_grown: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _grown.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, U64)
        steps[0] = 1
        have = _grown[base] = np.multiply.accumulate(steps)
    return have[:n]


class Spans:
    """64-bit hashes of any spans of one byte array, from one pass over it."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(byte_values(seed)[data] * powers(BASE, len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = powers(_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(BASE))


def chunks(batches: Iterable[pa.RecordBatch], text: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts have about `size` bytes, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = buffers(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more at the end); null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    raw = column.buffers()
    if len(column) == 0 or raw[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(raw[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@cache
def _crc_table() -> np.ndarray:
    """The crc32 step of each byte, by its rule: eight shifts with the reversed polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None, column: int = 64) -> np.ndarray:
    """The unsigned crc32 of each span; `before` is that of bytes that precede it. Spans go byte by byte, all at once;
    those of more than `column` bytes one by one."""
    table, n = _crc_table(), ends - starts
    found = np.zeros(len(starts), np.uint32) if before is None else before.astype(np.uint32)
    order = np.argsort(-np.minimum(n, column + 1), kind="stable")
    long = int(np.searchsorted(-n[order], -column, "left")) if len(n) and n.max() > column else 0
    for i in order[:long].tolist():
        found[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(found[i]))
    order = order[long:]
    at, left = starts[order], n[order]
    state = ~found[order]
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, "left"))
        state[:m] = table[(state[:m] ^ data[at[:m] + k]) & 255] ^ (state[:m] >> 8)
    found[order] = ~state
    return found


class Words:
    """The words of many texts: which text, the byte span, and a 64-bit hash of the folded bytes (made when asked for)."""

    def __init__(self, column: pa.Array, letters: np.ndarray, fold: np.ndarray = AS_IS):
        raw, self.offsets = buffers(column)
        self.data = raw if fold is AS_IS else fold[raw]
        self.n_texts = len(column)
        inside = letters[self.data]
        opens, closes = inside.copy(), inside.copy()
        if len(raw):
            opens[1:] &= ~inside[:-1]
            closes[:-1] &= ~inside[1:]
            bounds = self.offsets[1:-1]
            bounds = bounds[(bounds > 0) & (bounds < len(raw))]
            opens[bounds] = inside[bounds]
            closes[bounds - 1] = inside[bounds - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.firsts = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.firsts)
        self.text = np.repeat(np.arange(self.n_texts), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        return Spans(self.data).of(self.starts, self.ends)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words one after the other, a space behind each, and where each begins and ends there."""
        size = self.ends - self.starts
        ends = np.cumsum(size + 1) - 1
        begins = ends - size
        data = np.full(int(size.sum()) + len(size), 32, np.uint8)
        shift = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        data[np.repeat(begins, size) + shift] = self.data[np.repeat(self.starts, size) + shift]
        return data, begins, ends


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and text of each line, and each text's first line; a text has a line more than line feeds."""
    ends = np.flatnonzero(data == 10)
    n = len(offsets) - 1
    stop = np.r_[ends, offsets[1:]]
    owner = np.r_[np.searchsorted(offsets, ends, "right") - 1, np.arange(n)]
    order = np.lexsort((np.r_[np.zeros(len(ends)), np.ones(n)], stop, owner))
    stop, owner = stop[order], owner[order]
    firsts = np.searchsorted(owner, np.arange(n + 1))
    start = np.r_[0, stop[:-1] + 1][:len(stop)]
    start[firsts[:-1]] = offsets[:-1]
    return start, stop, owner, firsts


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` consecutive hashes; the caller drops runs that cross texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    found = hashes[:n].copy()
    for k in range(1, width):
        found *= U64(BASE)
        found += hashes[k:k + n]
    return mix(found)


def within(firsts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of the n - width + 1 runs lie in a single text."""
    if n < width:
        return np.zeros(0, bool)
    inside = np.ones(n - width + 1, bool)
    for first in range(1, width):
        cut = firsts[1:-1] - first
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return inside


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's bigint."""
    return np.ascontiguousarray(x).view(np.int64)


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]
