"""Spelling variants: words one edit apart, by composing finite-state machines.

Words are the runs of Latin letters of all texts, each with a deterministic slip made of the document's id; those of
`min_letters` code points and `min_occurrences` are the vocabulary. Two words are near if one inserted, deleted or
replaced code point leads from one to the other; a word's form is its most frequent near word, if that is `ratio`
times as frequent, and its root the end of the forms that follow.

1. Words are counted over all texts, partially before they are shuffled.
2. The vocabulary is a minimised acceptor, cut by its states after `stem` letters: two near words that differ behind
   their first `stem` letters begin in the same state, and two that differ before share their last `stem` letters, so
   that they begin in the same state of the acceptor of reversed words. A word therefore goes to two places.
3. A task joins whole states to batches of about `batch_words` words and composes acceptor, one-edit transducer and
   acceptor again: `Acceptor` numbers words by their paths; `near_pairs` starts at every state with the edit and goes
   on along letters that both sides have, once for each pair of states, whatever the number of prefixes that lead there.
   A word takes along how many near words it met and the best, never the pairs.
4. A state with more than `state_words` words (a beginning that a third of all words have) is not composed as a whole:
   its words meet by what is left of them around one letter, keys that at most one word for each letter and one more share.

Roots follow forms by pointer doubling: a form is `ratio` times as frequent, so chains have at most 18 steps for
counts below 2**63 and ratio 10.

A null text has no words. A null id makes the slips of an empty one. Rows that repeat an id count again. Words of any
length are kept whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.textbytes import LOWER, U64, Spans, buffers, chunks, crc32s, mix
from inkveil.session import staged

MET = "word string, n_near long, best_n long, best string"


@dataclass(frozen=True)
class SpellingParams:
    min_letters: int = 7
    min_occurrences: int = 2
    #: One run in so many loses a letter.
    slip: int = 31
    ratio: int = 10
    #: Letters after which the acceptor is cut; at most (min_letters - 1) / 2, so that two near words share one side.
    stem: int = 3
    batch_words: int = 1 << 16
    state_words: int = 1 << 18
    #: Distinct words a task holds before it passes its counts on.
    held_words: int = 1 << 19


def runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lowered, and start, end and text of each run of Latin letters (U+00C0 to U+00FF are C3 and a byte more)."""
    raw, offsets = buffers(column)
    lead = raw == 0xC3
    inside = ((raw | 32) >= 97) & ((raw | 32) <= 122) | lead
    inside[1:] |= lead[:-1]
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    # Texts that end in a letter and begin with one stand side by side: a bound between them cuts.
    bounds = offsets[1:-1]
    bounds = np.unique(bounds[(bounds > 0) & (bounds < len(raw))])
    bounds = bounds[inside[bounds - 1] & inside[bounds]]
    starts = np.sort(np.r_[np.flatnonzero(edge == 1), bounds])
    ends = np.sort(np.r_[np.flatnonzero(edge == -1), bounds])
    return LOWER[raw], starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of `<id>:` for each row, and where each begins."""
    named = ["" if x is None else str(x) for x in column.to_pylist()]
    return np.frombuffer("".join(f"{x}:" for x in named).encode(), np.uint8), np.cumsum([0, *(len(x) + 1 for x in named)])


def slipped(rows: pa.RecordBatch, params: SpellingParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of enough letters after slips: their bytes one after the other, starts and ends."""
    data, starts, ends, text = runs(rows.column("text"))
    letter = np.r_[0, np.cumsum(data & 0xC0 != 0x80)]
    n = letter[ends] - letter[starts]
    keep = n >= params.min_letters
    starts, ends, text, n = starts[keep], ends[keep], text[keep], n[keep]
    names, at = _ids(rows.column("doc_id"))
    h = crc32s(data, starts, ends, crc32s(names, at[:-1], at[1:])[text]).astype(np.int64)
    slips = h % params.slip == 0
    # Which bytes stay: those of the words but for each slip's letter.
    mark = np.zeros(len(data) + 1, np.int32)
    mark[starts] += 1
    np.add.at(mark, ends, -1)
    stays = np.cumsum(mark[:-1]) > 0
    places = np.flatnonzero(data & 0xC0 != 0x80)
    gone = places[letter[starts[slips]] + h[slips] % n[slips]]
    stays[gone] = False
    two = gone[data[gone] == 0xC3] + 1
    stays[two] = False
    kept = np.r_[0, np.cumsum(stays)]
    enough = n - slips >= params.min_letters
    return data[stays], kept[starts[enough]], kept[ends[enough]]


def _count(batches: Iterator[pa.RecordBatch], params: SpellingParams) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}
    for rows in chunks(batches, "text"):
        data, starts, ends = slipped(rows, params)
        _, first, counts = np.unique(Spans(data, 11).of(starts, ends), return_index=True, return_counts=True)
        whole = data.tobytes()
        for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), counts.tolist(), strict=True):
            word = whole[a:b]
            held[word] = held.get(word, 0) + n
        if len(held) > params.held_words:
            yield _counted(held)
            held = {}
    yield _counted(held)


def _counted(held: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """(word, n): every word of the texts that occurs often enough, and how often."""
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_count, params=params), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= params.min_occurrences)


class Acceptor:
    """The minimised acceptor of words in order, by arcs, with the number of words that each state accepts.

    A word's number is the sum over its path of the words that come before: those that end on the way and those of the
    arcs before the one taken. Letters are single bytes (Latin-1), whose order is that of code points.
    """

    def __init__(self, words: list[bytes]):
        n = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(n) - n
        common = self._common(data, at, n)
        # A trie node is the first word with its prefix, and its depth; node 0 is the root.
        fresh = n - common
        owner = np.repeat(np.arange(len(words)), fresh)
        depth = np.arange(len(owner)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + np.repeat(common, fresh) + 1
        letter = data[at[owner] + depth - 1]
        order = np.argsort(depth, kind="stable")
        owner, depth, letter = owner[order], depth[order], letter[order]
        # The parent of a node is the last node of the depth above whose first word is not behind its own.
        levels = np.searchsorted(depth, np.arange(1, int(n.max(initial=0)) + 2))
        parent = np.zeros(len(owner), np.int64)
        for d in range(1, len(levels) - 1):
            above, here = slice(levels[d - 1], levels[d]), slice(levels[d], levels[d + 1])
            parent[here] = levels[d - 1] + np.searchsorted(owner[above], owner[here], "right")
        final = np.zeros(len(owner) + 1, bool)
        final[1:] = depth == n[owner]
        # States with equal right languages are one: hashes of those languages, from the longest words up.
        language = mix(final.astype(U64) + U64(0x5EED))
        accepts = final.astype(np.int64)
        for d in range(len(levels) - 2, -1, -1):
            here = np.arange(levels[d], levels[d + 1]) + 1
            up = parent[here - 1]
            np.add.at(language, up, mix(language[here] * U64(257) + letter[here - 1].astype(U64)))
            np.add.at(accepts, up, accepts[here])
        _, node, state = np.unique(language, return_index=True, return_inverse=True)
        self.final, self.accepts, self.root = final[node], accepts[node], int(state[0])
        # The arcs of each state, from the node that stands for it.
        stands = np.zeros(len(language), bool)
        stands[node] = True
        arc = np.flatnonzero(stands[parent])
        source, letter, target = state[parent[arc]], letter[arc], state[arc + 1]
        order = np.lexsort((letter, source))
        self.source, self.letter, self.target = source[order], letter[order], target[order]
        self.first = np.searchsorted(self.source, np.arange(len(node) + 1))
        before = np.r_[0, np.cumsum(self.accepts[self.target])]
        self.skipped = before[:-1] - before[self.first[self.source]] + self.final[self.source]
        # How often each state is reached, and by which words: the trie's nodes with the number of their first word.
        self.node_state, self.node_word, self.node_depth = state, np.r_[0, owner], np.r_[0, depth]

    @staticmethod
    def _common(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The letters that each word shares with the one before it."""
        common = np.zeros(len(n), np.int64)
        open_, k = np.arange(1, len(n)), 0
        while len(open_):
            open_ = open_[(n[open_] > k) & (n[open_ - 1] > k)]
            open_ = open_[data[at[open_] + k] == data[at[open_ - 1] + k]]
            k += 1
            common[open_] = k
        return common

    def depths_left(self, most: int) -> np.ndarray:
        """Which states accept a word of at most `most` letters."""
        near = self.final.copy()
        for _ in range(most):
            near[self.source[near[self.target]]] = True
        return near

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of these states: the index into `states`, and the arc."""
        n = self.first[states + 1] - self.first[states]
        which = np.repeat(np.arange(len(states)), n)
        return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.first[states][which]

    def step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The arc by which each state reads its letter, -1 where it has none."""
        keys = self.source * 256 + self.letter
        wanted = states * 256 + letters
        found = np.searchsorted(keys, wanted)
        found[found == len(keys)] = 0
        return np.where(keys[found] == wanted, found, -1) if len(keys) else np.full(len(states), -1)


def near_pairs(machine: Acceptor, from_depth: int = 0, tail: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of all words that are one edit apart, each pair once, in slices; edits at `from_depth` letters or more,
    and, with `tail`, with at most `tail` letters behind the edit."""
    starts = np.unique(machine.node_state[machine.node_depth >= from_depth])
    if tail is not None:
        starts = starts[machine.depths_left(tail + 1)[starts]]
    # Composite states: the state of the edit, both sides' states, and the words before them on either side.
    which, one = machine.arcs(starts)
    behind = machine.first[starts[which] + 1] - one - 1
    pair = np.repeat(np.arange(len(one)), behind)
    other = one[pair] + 1 + np.arange(len(pair)) - np.repeat(np.cumsum(behind) - behind, behind)
    edited = np.r_[starts[which][pair], starts[which]]  # a letter for another one, and a letter more
    left = np.r_[machine.target[one[pair]], machine.target[one]]
    right = np.r_[machine.target[other], starts[which]]
    left_n = np.r_[machine.skipped[one[pair]], machine.skipped[one]]
    right_n = np.r_[machine.skipped[other], np.zeros(len(one), np.int64)]
    # An inserted letter stands where the words part: the shorter word does not go on with it.
    banned = np.r_[np.full(len(pair), -1), machine.letter[one].astype(np.int64)]
    found = []
    steps = 0
    while len(edited):
        both = machine.final[left] & machine.final[right]
        found.append((edited[both], left_n[both], right_n[both]))
        steps += 1
        if tail is not None and steps > tail:
            break
        which, arc = machine.arcs(left)
        allowed = machine.letter[arc] != banned[which]
        which, arc = which[allowed], arc[allowed]
        match = machine.step(right[which], machine.letter[arc])
        which, arc, match = which[match >= 0], arc[match >= 0], match[match >= 0]
        edited, left, right, banned = edited[which], machine.target[arc], machine.target[match], np.full(len(which), -1)
        left_n, right_n = left_n[which] + machine.skipped[arc], right_n[which] + machine.skipped[match]
    state = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(state, kind="stable")
    left_n = np.concatenate([f[1] for f in found])[order] if found else state
    right_n = np.concatenate([f[2] for f in found])[order] if found else state
    first = np.searchsorted(state[order], np.arange(len(machine.accepts) + 1))
    # Every prefix that leads to the state of an edit has these pairs, behind its own first word.
    nodes = np.flatnonzero(machine.node_depth >= from_depth)
    n = np.diff(first)[machine.node_state[nodes]]
    ends = np.cumsum(n)
    at = 0
    while at < len(nodes):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")), at + 1)
        own = nodes[at:to]
        rep = np.repeat(np.arange(len(own)), n[at:to])
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(n[at:to]) - n[at:to], n[at:to]) + first[machine.node_state[own]][rep]
        base = machine.node_word[own][rep]
        yield base + left_n[inner], base + right_n[inner]
        at = to


def composed(words: list[str], counts: np.ndarray, stem: int, backward: bool) -> pa.RecordBatch:
    """What each word of some whole states meets: number of near words, count and text of the best of them.

    Forward the words may differ behind their first `stem` letters, backward before them.
    """
    spelled = [w.encode("latin-1") for w in words]
    keyed = [w[::-1] for w in spelled] if backward else spelled
    order = sorted(range(len(words)), key=keyed.__getitem__)
    n_near = np.zeros(len(words), np.int64)
    rank = np.empty(len(words), np.int64)  # of the better word: more occurrences, then smaller
    rank[sorted(range(len(words)), key=lambda i: (-counts[i], spelled[i]))] = np.arange(len(words))
    by_rank = np.argsort(rank)
    best = np.full(len(words), len(words))
    place = np.array(order, np.int64)
    beginnings: dict[bytes, int] = {}
    head = np.array([beginnings.setdefault(w[:stem], len(beginnings)) for w in spelled], np.int64)
    for a, b in near_pairs(Acceptor([keyed[i] for i in order]), stem, stem - 1 if backward else None):
        a, b = place[a], place[b]
        if backward:  # those that part behind the first letters are met forward
            apart = head[a] != head[b]
            a, b = a[apart], b[apart]
        for one, other in ((a, b), (b, a)):
            np.add.at(n_near, one, 1)
            np.minimum.at(best, one, rank[other])
    met = np.flatnonzero(n_near)
    chosen = by_rank[best[met]]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in met.tolist()], pa.string()), pa.array(n_near[met]), pa.array(counts[chosen]),
         pa.array([words[i] for i in chosen.tolist()], pa.string())], ["word", "n_near", "best_n", "best"])


def _compose(batches: Iterator[pa.RecordBatch], params: SpellingParams, backward: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by state; whole states are composed together up to `batch_words`."""
    words: list[str] = []
    counts: list[int] = []
    last = None
    for batch in batches:
        states = batch.column("state").to_pylist()
        for state, word, n in zip(states, batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
            if state != last and len(words) >= params.batch_words:
                yield composed(words, np.array(counts, np.int64), params.stem, backward)
                words, counts = [], []
            words.append(word)
            counts.append(n)
            last = state
    if words:
        yield composed(words, np.array(counts, np.int64), params.stem, backward)


def _around(words: DataFrame, first: Column, last: Column) -> DataFrame:
    """What words meet that part at a letter from `first` to `last` (counted from 0), by keys of what is left of them.

    A key is the place, the letters before it and those behind it: a word has it once as one that has a letter there
    (`letter`), and once as one that has none.
    """
    length = F.length("word")
    places = words.select("word", "n", F.explode(F.sequence(first, F.least(last, length))).alias("i"))
    with_letter = places.where(F.col("i") < length).select(
        "word", "n", "i", F.substring("word", F.col("i") + 1, F.lit(1)).alias("letter"),
        F.substring("word", F.lit(1), F.col("i")).alias("head"), F.substring("word", F.col("i") + 2, length).alias("rest"))
    without = places.select(
        "word", "n", "i", F.lit(None).cast("string").alias("letter"),
        F.substring("word", F.lit(1), F.col("i")).alias("head"), F.substring("word", F.col("i") + 1, length).alias("rest"))
    met = with_letter.unionAll(without).groupBy("i", "head", "rest").agg(
        F.collect_list(F.struct("word", "n", "letter")).alias("all")).where(F.size("all") > 1)
    one = met.select("rest", "all", F.explode("all").alias("one"))
    # Words part here only if the shorter one does not go on with the longer one's letter.
    parts = lambda a, b: (a["word"] != b["word"]) & (
        F.coalesce(a["letter"], F.substring("rest", 1, 1)) != F.coalesce(b["letter"], F.substring("rest", 1, 1)))
    near = one.select("one.word", F.filter("all", lambda other: parts(F.col("one"), other)).alias("near")).where(F.size("near") > 0)
    best = F.array_sort("near", lambda a, b: F.when(a["n"] != b["n"], F.when(a["n"] > b["n"], -1).otherwise(1))
                        .when(a["word"] < b["word"], -1).otherwise(1))[0]
    return near.select("word", F.size("near").cast("long").alias("n_near"), best["n"].alias("best_n"), best["word"].alias("best"))


def met(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """(word, n_near, best_n, best) of each word that has near words; `words` is a table of distinct words."""
    found = []
    for backward in (False, True):
        stem = F.substring("word", -params.stem, params.stem) if backward else F.substring("word", 1, params.stem)
        rows = words.select("word", "n", stem.alias("state"))
        crowded = staged(rows.groupBy("state").agg(F.count("*").alias("m")).where(F.col("m") > params.state_words).select("state"), "crowded")
        split = not crowded.isEmpty()
        small = rows.join(crowded, "state", "left_anti").select("state", "word", "n") if split else rows.select("state", "word", "n")
        found.append(small.repartition("state").sortWithinPartitions("state").mapInArrow(
            partial(_compose, params=params, backward=backward), MET))
        if split:
            large = rows.join(crowded, "state", "left_semi")
            first, last = (F.lit(0), F.lit(params.stem - 1)) if backward else (F.lit(params.stem), F.length("word"))
            found.append(_around(large, first, last))
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    return every.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def variants(docs: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of the vocabulary."""
    words = staged(vocabulary(docs, params), "words")
    near = met(words, params)
    chosen = F.col("best_n") >= params.ratio * F.col("n")
    rows = staged(words.join(near, "word", "left").select(
        "word", F.when(chosen, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(chosen, F.col("best_n")).alias("form_n")), "forms")
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # a step is twice as long each time
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = staged(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
