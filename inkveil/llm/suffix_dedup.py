"""Repeated passages by suffix arrays and longest-previous-factor arrays.

A byte is repeated when a string of `min_bytes` bytes that covers it also starts elsewhere, in another text or
further on in its own. `spans` finds for every text the window starts that repeat, and whether an earlier
occurrence exists (order: id, hash of the text, position); `remove_later` keeps first occurrences, `digest`
removes every occurrence.

How the work is spread. Every window of `min_bytes` bytes belongs to one anchor, the `anchor_bytes`-gram in it
with the least hash, so equal windows have equal anchors at equal places. A text is a row of fragments, one per
anchor: the windows that belong to it, consecutive starts. Fragments meet by anchor.

1. Anchors seen once are unique: all their windows are. This settles most of a corpus with one row per fragment
   (one in about 170 bytes), counted before it is shuffled.
2. Equal fragments repeat as a whole; one of them, the first, stands for all. Groups of copies end here, as counts.
3. The distinct fragments of an anchor are brought together as bytes, at most `bucket` of them, and sorted by a
   suffix array. Longest-previous-factor arrays, from the previous and next smaller position in suffix order, say
   which windows occur earlier; the same with greater positions says which occur later.
4. An anchor with more distinct fragments than that (a line that a third of all texts holds) is split: its windows
   are dealt to narrower buckets by the bytes all of them share, with steps 1 to 3 again, down to one window, where
   equal bytes are counted and nothing is left to sort. No fragment is dropped at any size.

With `folded`, texts are compared by their words alone (letters and digits, lower case, a space behind each), so that
capitals, marks and line breaks hide no repeat; `remove_later` then cuts whole words of the text as it is, and with
`min_words` only passages of so many words between white space; `min_bytes` must be no more than the least bytes that
such a passage can have (a byte a word and one between two). With `across`, an earlier occurrence counts only where it
is in another text: a text that repeats itself is left as it is, unless an earlier text has the passage too; then each of
its occurrences goes. With all three, one earlier text must have the passage: consecutive windows may each occur in
another text (or, in a word said over and over, at one place), so the stretches of `min_words` compared words in such
runs are met by hash, and those that an earlier text has go. Fewer compared words are a passage too where marks that
stand alone, between them or at either end, make them `min_words` between white space in both texts; the marks at the ends stay.

Null texts are empty. Texts shorter than `min_bytes` have no window. Rows that repeat id and text are two
occurrences for `digest` and one text for `remove_later`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkveil.llm.rows import discard, keyed, packed
from inkveil.llm.textbytes import ALPHANUMERIC, BASE, LOWER, SPACED, U64, Spans, Words, buffers, chunks, mix, signed, texts
from inkveil.session import scratch_dir, staged

FRAGMENT = "_id bigint, _th bigint, lo bigint, hi bigint, p bigint, k bigint, f bigint"
PIECE = "k bigint, _id bigint, _th bigint, lo bigint, hi bigint, p bigint, piece binary"
FOUND = "_id bigint, _th bigint, s bigint, e bigint, earlier boolean"
STRETCH = "w bigint, _id bigint, _th bigint"


@dataclass(frozen=True)
class SuffixParams:
    min_bytes: int = 400
    anchor_bytes: int = 64
    #: Compare words only; see above.
    folded: bool = False
    #: Words that a run of repeated windows must hold for `remove_later` to cut it, where texts are folded.
    min_words: int = 0
    #: Only occurrences in another text count as earlier ones.
    across: bool = False
    #: Distinct fragments that one suffix array takes; more are split, not cut.
    bucket: int = 2048
    #: Windows per bucket at each split; the last must be 1.
    splits: tuple[int, ...] = (42, 6, 1)
    #: Bytes that one suffix array takes, unless a single bucket has more.
    sort_bytes: int = 1 << 20

    @property
    def by_words(self) -> bool:
        """Whether one earlier text must have `min_words` words of a passage; see above."""
        return self.folded and self.across and self.min_words > 0


def _met(rows: DataFrame) -> DataFrame:
    """The rows whose anchor occurs again. The anchors are a table of their own: adaptive execution can split the join
    of one that a third of all texts have, which it cannot where an aggregate feeds the join."""
    met = rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    return rows.join(staged(met, "met"), "k", "left_semi")


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive keys."""
    n = len(keys) - width + 1
    filled = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, U64)
    filled[:len(keys)] = keys
    rows = filled.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def _compared(column: pa.Array, params: SuffixParams) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that are compared, and where each text begins (one more at the end)."""
    if not params.folded:
        return buffers(column)
    words = Words(column, ALPHANUMERIC, LOWER)
    data, begins, _ = words.joined()
    return data, np.r_[begins, len(data)][words.firsts]


def _fragments(batches: Iterator[pa.RecordBatch], params: SuffixParams) -> Iterator[pa.RecordBatch]:
    size, gram = params.min_bytes, params.anchor_bytes
    for rows in chunks(batches, "_text"):
        data, offsets = _compared(rows.column("_text"), params)
        if len(data) < size:
            continue
        starts = np.arange(len(data) - size + 1)
        text = np.repeat(np.arange(rows.num_rows), np.diff(offsets))[:len(starts)]
        valid = starts + size <= offsets[text + 1]
        if not valid.any():
            continue
        first, second = Spans(data, 1), Spans(data, 2)
        at = np.arange(len(data) - gram + 1)
        hashes = first.of(at, at + gram)
        order = (hashes & U64(0xFFFFFFFF00000000)) | at.astype(U64)
        anchor = (_least(order, size - gram + 1) & U64(0xFFFFFFFF)).astype(np.int64)[valid]
        starts, text = starts[valid], text[valid]
        opens = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        lo, p, owner = starts[opens], anchor[opens], text[opens]
        hi = starts[np.r_[opens[1:], len(starts)] - 1]
        content = mix(second.of(lo, hi + size) * U64(BASE) + (p - lo).astype(U64))
        base = offsets[owner]
        yield pa.RecordBatch.from_arrays(
            [rows.column("_id").take(pa.array(owner)), rows.column("_th").take(pa.array(owner)), lo - base, hi - base,
             p - base, signed(hashes[p]), signed(content)], ["_id", "_th", "lo", "hi", "p", "k", "f"])


def _pieces(batches: Iterator[pa.RecordBatch], params: SuffixParams) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted fragment of a text."""
    for rows in chunks(batches, "_text"):
        data, offsets = _compared(rows.column("_text"), params)
        wanted = rows.column("wanted")
        flat = wanted.flatten()
        owner = np.repeat(np.arange(rows.num_rows), np.diff(wanted.offsets.to_numpy()))
        lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
        base = offsets[owner]
        whole = data.tobytes()
        piece = [whole[a:b] for a, b in zip((base + lo).tolist(), (base + hi + params.min_bytes).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [flat.field("k"), rows.column("_id").take(pa.array(owner)), rows.column("_th").take(pa.array(owner)),
             flat.field("lo"), flat.field("hi"), flat.field("p"), pa.array(piece, pa.binary())],
            ["k", "_id", "_th", "lo", "hi", "p", "piece"])


def _sub_windows(batches: Iterator[pa.RecordBatch], params: SuffixParams, width: int) -> Iterator[pa.RecordBatch]:
    """Each fragment as narrower ones, met by the bytes that all windows of the narrower range share."""
    size = params.min_bytes
    for rows in chunks(batches, "piece"):
        data, offsets = buffers(rows.column("piece"))
        first, second = Spans(data, 3), Spans(data, 4)
        lo, hi, p = (rows.column(c).to_numpy() for c in ("lo", "hi", "p"))
        # A window is known by how far it begins before its anchor; ranges of that distance are the same in all texts.
        near, far = (p - hi) // width, (p - lo) // width
        n = far - near + 1
        owner = np.repeat(np.arange(len(lo)), n)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + near[owner]
        at = offsets[owner] + p[owner] - lo[owner]
        a1, a2 = part * width, part * width + width - 1
        shared_from, shared_to = at - a1, at - a2 + size
        sub_lo, sub_hi = np.maximum(lo[owner], p[owner] - a2), np.minimum(hi[owner], p[owner] - a1)
        start = offsets[owner] - lo[owner]
        keys = rows.column("k").to_numpy().view(U64)[owner]
        key = mix(first.of(shared_from, shared_to) + keys * U64(BASE) + part.astype(U64))
        content = mix(second.of(start + sub_lo, start + sub_hi + size) * U64(BASE) + (p[owner] - sub_lo).astype(U64))
        yield pa.RecordBatch.from_arrays(
            [rows.column("_id").take(pa.array(owner)), rows.column("_th").take(pa.array(owner)), sub_lo, sub_hi,
             p[owner], signed(key), signed(content)], ["_id", "_th", "lo", "hi", "p", "k", "f"])


def _ranks(order_keys: np.ndarray) -> np.ndarray:
    order = np.argsort(order_keys)
    ordered = order_keys[order]
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
    return ranks


def suffix_order(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings of `size` bytes at `starts`, and each one's common prefix with the one before it.

    Ranks of all positions by their first 8, 16, 32 ... bytes, each level from the one before; the last level
    overlaps the two halves of a window. Common prefixes are read off the same levels, longest first.
    """
    n = len(data)
    wide = np.zeros(n + 8, np.uint8)
    wide[:n] = data
    first = np.zeros(n, U64)
    for k in range(8):
        first = (first << U64(8)) | wide[k:k + n].astype(U64)
    levels, length = [(8, _ranks(first))], 8
    while length * 2 <= size:
        ranks = levels[-1][1]
        later = np.zeros(n, np.int64)
        later[:n - length] = ranks[length:] + 1
        levels.append((length * 2, _ranks(ranks.astype(np.int64) * (n + 1) + later)))
        length *= 2
    ranks = levels[-1][1].astype(np.int64)
    order = np.argsort(ranks[starts] * (n + 1) + ranks[starts + size - length], kind="stable")
    a, b = starts[order[:-1]], starts[order[1:]]
    common = np.zeros(len(a), np.int64)
    for length, ranks in reversed(levels):
        for _ in range(2):
            x, y = a + common, b + common
            fits = (common + length <= size) & (x < n) & (y < n)
            same = np.zeros(len(a), bool)
            same[fits] = ranks[x[fits]] == ranks[y[fits]]
            common[same] += length
    for _ in range(8):
        x, y = a + common, b + common
        common[(common < size) & (wide[np.minimum(x, n)] == wide[np.minimum(y, n)])] += 1
    return order, np.r_[0, np.minimum(common, size)]


def previous_factor(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in order, the longest prefix that also starts at a smaller place.

    `common[i]` is the common prefix of suffix i with suffix i - 1. The previous and the next suffix of smaller
    place are found by pointer jumping: a candidate that is not smaller is replaced by its own candidate, and
    the common prefix to it is the least one on the way.
    """
    return np.maximum(_to_smaller(places, common), _to_smaller(places[::-1], np.r_[0, common[:0:-1]])[::-1])


def _to_smaller(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    n = len(places)
    to = np.arange(-1, n - 1)
    least = common.copy()
    places = np.r_[places, np.iinfo(np.int64).min]  # index -1: smaller than all, with nothing in common
    if n:
        least[0] = 0
    open_ = np.flatnonzero(places[to] >= places[:n])
    while len(open_):
        over = to[open_]
        least[open_] = np.minimum(least[open_], least[over])
        to[open_] = to[over]
        open_ = open_[places[to[open_]] >= places[open_]]
    return np.where(to < 0, 0, least)


def _sorted_bucket(rows: pa.Table, params: SuffixParams) -> pa.RecordBatch | None:
    """Runs of window starts of each fragment that occur earlier, or later, in the same buckets."""
    size = params.min_bytes
    # Rows that repeat id and text bring their pieces once each, but are one place; that they repeat is counted before.
    places = np.stack([rows.column(c).to_numpy() for c in ("_id", "_th", "lo")])
    once = np.unique(places, axis=1, return_index=True)[1]
    rows = (rows if len(once) == rows.num_rows else rows.take(pa.array(np.sort(once)))).combine_chunks()
    data, offsets = buffers(rows.column("piece").combine_chunks())
    lo, hi = rows.column("lo").to_numpy(), rows.column("hi").to_numpy()
    n = hi - lo + 1
    owner = np.repeat(np.arange(len(lo)), n)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[owner] + inner
    order, common = suffix_order(data, starts, size)
    kept = (common >= size) | np.r_[common[1:] >= size, False]
    sub, joint = order[kept], common[kept]
    # Of the suffixes left out none has a whole window in common with a neighbour.
    joint = np.where(joint >= size, joint, 0)
    ids, hashes = rows.column("_id").to_numpy(), rows.column("_th").to_numpy()
    by_place = np.lexsort((lo[owner[sub]] + inner[sub], hashes[owner[sub]], ids[owner[sub]]))
    place = np.empty(len(sub), np.int64)
    place[by_place] = np.arange(len(sub))
    if params.across:  # one place a text
        id_, hash_ = ids[owner[sub]][by_place], hashes[owner[sub]][by_place]
        place[by_place] = np.cumsum(np.r_[0, (id_[1:] != id_[:-1]) | (hash_[1:] != hash_[:-1])])[:len(sub)]
    earlier, later = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
    earlier[sub] = previous_factor(place, joint) >= size
    later[sub] = previous_factor(-place, joint) >= size
    code = earlier * 2 + (later & ~earlier)
    hit = np.flatnonzero(code)
    if not len(hit):
        return None
    breaks = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (np.diff(code[hit]) != 0) | (np.diff(owner[hit]) != 0)])
    opened, closed = hit[breaks], hit[np.r_[breaks[1:], len(hit)] - 1]
    who = owner[opened]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[who]), pa.array(hashes[who]), pa.array(lo[who] + inner[opened]), pa.array(lo[who] + inner[closed]),
         pa.array(code[opened] == 2)], ["_id", "_th", "s", "e", "earlier"])


def _sort_buckets(batches: Iterator[pa.RecordBatch], params: SuffixParams) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; whole buckets are sorted together up to `sort_bytes`."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("k").to_numpy()
        cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        _, offsets = buffers(batch.column("piece"))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if size >= params.sort_bytes and keys[a] != last:
                found = _sorted_bucket(pa.Table.from_batches(held), params)
                if found is not None:
                    yield found
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += int(offsets[b] - offsets[a])
            last = keys[a]
    if held and (found := _sorted_bucket(pa.Table.from_batches(held), params)) is not None:
        yield found


def spans(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """Window starts s..e of each text (`_id`, `_th`) whose `min_bytes` bytes occur elsewhere, and whether earlier.

    `docs` needs doc_id and text. A window may be listed twice, never with `earlier` false where an earlier
    occurrence exists in all lists.
    """
    keys, spark = keyed(docs), docs.sparkSession
    anchors = scratch_dir(spark, "anchors")
    keys.mapInArrow(partial(_fragments, params=params), FRAGMENT).write.parquet(anchors)
    rows = _met(spark.read.schema(FRAGMENT).parquet(anchors))
    found = []
    for width in (*params.splits, 0):
        rows = staged(rows.select("_id", "_th", "lo", "hi", "p", "k", "f"), "fragments")
        if width == params.splits[0]:  # most anchors are unique, and the others are a table of their own now
            discard(spark, anchors)
        distinct = staged(
            rows.groupBy("k", "f").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_th", "lo", "hi", "p")).alias("at")),
            "distinct")
        copies = distinct.where("n > 1").select("k", "f", "at")
        order = ("_id", "_th") if params.across else ("_id", "_th", "lo")
        found.append(rows.join(copies, ["k", "f"]).select(
            "_id", "_th", F.col("lo").alias("s"), F.col("hi").alias("e"),
            (F.struct(*order) > F.struct(*(f"at.{c}" for c in order))).alias("earlier")))
        buckets = staged(distinct.groupBy("k").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
        if not width or buckets.isEmpty():
            break
        wanted = distinct.join(buckets, "k").select("k", "at.*")
        by_text = wanted.groupBy("_id", "_th").agg(F.collect_list(F.struct("k", "lo", "hi", "p")).alias("wanted"))
        pieces = keys.join(by_text, ["_id", "_th"]).mapInArrow(partial(_pieces, params=params), PIECE)
        crowded = buckets.where(F.col("m") > params.bucket)
        split = not crowded.isEmpty()
        if split:
            pieces = staged(pieces, "pieces")
            small, large = pieces.join(crowded, "k", "left_anti"), pieces.join(crowded, "k", "left_semi")
        else:
            small = pieces
        small = small.select("k", "_id", "_th", "lo", "hi", "p", "piece")
        found.append(staged(
            small.repartition("k").sortWithinPartitions("k").mapInArrow(partial(_sort_buckets, params=params), FOUND),
            "factors"))
        if not split:
            break
        large = large.select("k", "_id", "_th", "lo", "hi", "p", "piece")
        rows = large.mapInArrow(partial(_sub_windows, params=params, width=width), FRAGMENT)
        rows = _met(staged(rows, "narrower"))
    return reduce(DataFrame.unionAll, found)


def _union(listed, size: int, only_earlier: bool) -> list[tuple[int, int]]:
    """The bytes that the windows cover, as runs in order."""
    runs: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"] + size) for x in listed or () if x["earlier"] or not only_earlier):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    return [(s, e) for s, e in runs]


def _word_runs(starts, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, params: SuffixParams) -> tuple[np.ndarray, np.ndarray]:
    """The first and last whole word of each run of consecutive windows among those listed."""
    at = np.arange(len(data) - params.min_bytes + 1)
    goes = np.zeros(len(at) + 1, bool)
    for s, e in starts:
        goes[s:e + 1] = True
    if params.across:  # equal windows of the text itself: only one of them stood for all
        hashes = Spans(data, 5).of(at, at + params.min_bytes)
        goes[:-1] |= np.isin(hashes, hashes[goes[:-1]])
    edge = np.diff(np.r_[False, goes].astype(np.int8), append=0)
    opened, closed = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    first = np.searchsorted(begins, opened)
    last = np.searchsorted(ends, closed + params.min_bytes, "right") - 1
    return first[last >= first], last[last >= first]


def _between_spaces(words: Words, spaced: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a text the words between white space before a passage that it begins, and those through one that it
    ends; marks that stand alone next to the passage belong to it."""
    before = np.searchsorted(spaced.ends, words.starts, "right")
    through = np.searchsorted(spaced.starts, words.ends)
    return np.minimum(before, np.r_[0, through][:-1]), np.maximum(through, np.r_[before, len(spaced.starts)][1:])


def _word_windows(first: np.ndarray, last: np.ndarray, words: Words, spaced: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each stretch of `size` words in the runs, and of shorter ones that marks make as long."""
    n = last - first + 1
    i = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    stop = np.repeat(last, n)
    whole = i[i + size - 1 <= stop]
    found = [(whole, whole + size - 1)]
    before, through = _between_spaces(words, spaced)
    before = before[i]
    marked = through[np.minimum(i + size - 2, stop)] - before >= size if len(i) else np.zeros(0, bool)
    i, stop, before = i[marked], stop[marked], before[marked]
    for more in range(size - 1 if len(i) else 0):
        j = np.minimum(i + more, stop)
        long = (i + more <= stop) & (through[j] - before >= size)
        found.append((i[long], j[long]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _stretches(batches: Iterator[pa.RecordBatch], params: SuffixParams) -> Iterator[pa.RecordBatch]:
    """The hashes of the stretches of words in each text's runs of repeated windows."""
    for rows in chunks(batches, "_text"):
        hashes, counts = [], []
        for text, listed in zip(texts(rows.column("_text")), rows.column("_runs").to_pylist(), strict=True):
            column = pa.array([text.encode()], pa.binary())
            words, spaced = Words(column, ALPHANUMERIC, LOWER), Words(column, SPACED)
            data, begins, ends = words.joined()
            first, last = _word_runs(((x["s"], x["e"]) for x in listed), data, begins, ends, params)
            i, j = _word_windows(first, last, words, spaced, params.min_words)
            hashes.append(np.unique(Spans(data, 6).of(begins[i], ends[j])))
            counts.append(len(hashes[-1]))
        owner = pa.array(np.repeat(np.arange(rows.num_rows), counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(np.concatenate(hashes))), rows.column("_id").take(owner), rows.column("_th").take(owner)],
            ["w", "_id", "_th"])


def _confirmed(docs: DataFrame, params: SuffixParams) -> DataFrame:
    """Per text the hashes (`_runs`) of its stretches of words that one earlier text has."""
    listed = spans(docs, params).groupBy("_id", "_th").agg(F.collect_list(F.struct("s", "e")).alias("_runs"))
    rows = keyed(docs).join(listed, ["_id", "_th"]).mapInArrow(partial(_stretches, params=params), STRETCH)
    rows = staged(rows, "stretches")
    text = F.struct("_id", "_th")
    shared = rows.groupBy("w").agg(F.min(text).alias("first"), F.max(text).alias("last")).where("last > first")
    later = rows.join(staged(shared.select("w", "first"), "shared"), "w").where(text > F.col("first"))
    return later.groupBy("_id", "_th").agg(F.collect_set("w").alias("_runs"))


def _passages(listed, text: bytes, params: SuffixParams) -> list[tuple[int, int]]:
    """The bytes of a folded text's passages that go, whole words: those in runs of consecutive windows that occur earlier
    or, where `listed` has hashes, in stretches of words that an earlier text has.

    Passages that only touch are two: each must be long enough by itself.
    """
    if not listed:
        return []
    column = pa.array([text], pa.binary())
    words, spaced = Words(column, ALPHANUMERIC, LOWER), Words(column, SPACED)
    data, begins, ends = words.joined()
    if params.by_words:
        all_ = np.array([0]), np.array([len(begins) - 1])
        i, j = _word_windows(*all_, words, spaced, params.min_words)
        goes = np.isin(signed(Spans(data, 6).of(begins[i], ends[j])), np.array(listed, np.int64))
        i, j = i[goes], j[goes]
        order = np.lexsort((j, i))
        i, j = i[order], np.maximum.accumulate(j[order])
        opens = np.r_[True, i[1:] > j[:-1]]
        first, last = i[opens], j[np.r_[opens[1:], True]]
    else:
        first, last = _word_runs(((x["s"], x["e"]) for x in listed if x["earlier"]), data, begins, ends, params)
    start, stop = words.starts[first], words.ends[last]
    before, through = _between_spaces(words, spaced)
    n = through[last] - before[first]
    return [(s, e) for s, e, k in zip(start.tolist(), stop.tolist(), n.tolist(), strict=True) if k >= params.min_words]


def with_spans(docs: DataFrame, params: SuffixParams = SuffixParams(), only_earlier: bool = False) -> DataFrame:
    """`_row` (the document) and `_runs`, its runs of window starts, all or those that occur earlier; the spans are found
    when this is called."""
    found = spans(docs, params)
    listed = (found.where("earlier") if only_earlier else found).groupBy("_id", "_th").agg(F.collect_list(F.struct("s", "e", "earlier")).alias("_runs"))
    return packed(docs).join(listed, ["_id", "_th"], "left")


def _digests(batches: Iterator[pa.RecordBatch], params: SuffixParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        sizes, removed, counts, hashes = [], [], [], []
        for text, listed in zip(texts(rows.column("text")), rows.column("_runs").to_pylist(), strict=True):
            data = text.encode()
            runs = _union(listed, params.min_bytes, False)
            kept, at = hashlib.sha256(), 0
            for s, e in runs:
                kept.update(data[at:s])
                at = e
            kept.update(data[at:])
            sizes.append(len(data))
            removed.append(sum(e - s for s, e in runs))
            counts.append(len(runs))
            hashes.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
             pa.array(hashes, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digest(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """Per document the bytes that repeat anywhere, every occurrence removed, and a hash of what is left."""
    marked = with_spans(docs.select("doc_id", "text"), params).select("_row.doc_id", "_row.text", "_runs")
    return marked.mapInArrow(
        partial(_digests, params=params),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch], params: SuffixParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "_text"):
        kept = []
        for text, listed in zip(rows.column("_text").to_pylist(), rows.column("_runs").to_pylist(), strict=True):
            if params.folded:
                runs = _passages(listed, (text or "").encode(), params)
            else:
                runs = _union(listed, params.min_bytes, True)
            if runs:
                data, parts, at = text.encode(), [], 0
                for s, e in runs:
                    while s < e and data[s] & 0xC0 == 0x80:  # whole characters stay or go
                        s += 1
                    while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
                        e -= 1
                    parts.append(data[at:s])
                    at = e
                text = b"".join([*parts, data[at:]]).decode()
            kept.append(text)
        yield pa.RecordBatch.from_arrays([rows.column("_row"), pa.array(kept, pa.string())], ["_row", "_text"])


def remove_later(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """The documents with later occurrences cut out of their texts, first occurrences kept, whole characters only.

    All columns and rows are kept; n_chars, where there is one, is counted again. A null text stays null.
    """
    if params.by_words:
        marked = packed(docs).join(_confirmed(docs, params), ["_id", "_th"], "left")
    else:
        marked = with_spans(docs, params, only_earlier=True)
    row = marked.schema["_row"].dataType
    changed = F.col("_runs").isNotNull()
    whole = marked.select("_row", F.when(changed, F.col("_row.text")).alias("_text"), "_runs")
    schema = T.StructType([T.StructField("_row", row), T.StructField("_text", T.StringType())])
    cut = whole.mapInArrow(partial(_cut, params=params), schema)
    columns = []
    for name in row.fieldNames():
        now = F.col("_row")[name]
        if name == "text":
            now = F.when(F.col("_text").isNull(), now).otherwise(F.col("_text"))
        elif name == "n_chars":
            now = F.when(F.col("_text").isNull(), now).otherwise(F.length("_text").cast(row[name].dataType))
        columns.append(now.alias(name))
    return cut.select(columns)
