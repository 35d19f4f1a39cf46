"""Packing: ids and cuts against the reference tokenizer, sequences without gaps and near the least number."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from inkveil.llm.packing import PackParams, encode, matches, packed, plan

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def random_texts():
    rng = random.Random(2)
    letters = ["the ", "of ", "naïve", "\n\n", "  ", "’s", "日本", "🙂", "\t", "x1 ", "'ll", "é", "\r\n", "####", " "]
    found = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(120)]
    return [*found, "", None, "a", "word " * 3000, "z" * 5000, "\x00\x01 odd"]


def test_ids_are_those_of_the_tokenizer():
    for text in random_texts():
        assert encode(text or "").tolist() == reference_ids(text)


def test_added_tokens_inside_texts_are_those_of_the_tokenizer():
    end = "<|endoftext|>"
    for text in (end, f"a {end} b", f"a{end}b", f"{end}{end}\n\n {end}  x", f"{end[:-1]}{end}", f"<{end}>", f"é  {end}  é'{end}s", end.upper()):
        assert encode(text).tolist() == reference_ids(text)
    assert encode(f"a {end} b").tolist() == [64, 220, 50256, 275, 2]


def check(rows, texts, size):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = reference_ids(text), 0
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        for r in own:
            assert r.start == at and 0 < r.length <= size
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
        assert len(own) == 1 if len(ids) <= size else all(r.length == size for r in own[1:])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_pieces_fill_sequences_without_gaps(spark):
    texts = dict(enumerate(random_texts()))
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id bigint, text string, length int")
    for params in (PackParams(), PackParams(capacity=128, range_rows=40)):
        rows = packed(docs, params).collect()
        n = check(rows, texts, params.capacity)
        assert n <= 1.06 * -(-sum(r.length for r in rows) // params.capacity) + 2


def test_plan_is_near_the_least_number():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 1025, 20000), rng.geometric(1 / 300, 20000).clip(1, 1024), np.full(5000, 300),
                    rng.integers(340, 350, 3000), np.r_[np.full(1000, 1024), np.full(3, 1)]):
        counts = np.bincount(lengths, minlength=1025)
        runs = plan(counts, 1024)
        assert (np.bincount(runs[:, 0], weights=runs[:, 2], minlength=1025) == counts).all()
        opened = int((runs[:, 3] + runs[:, 2]).max())
        left = sorted(lengths.tolist(), reverse=True)
        best = best_fit_decreasing(left)
        assert opened <= 1.01 * best + 1, (opened, best)
        full = np.zeros(opened, np.int64)
        for length, _, n, first, offset in sorted(runs.tolist(), key=lambda r: r[4]):
            assert (full[first:first + n] == offset).all()
            full[first:first + n] += length
        assert full.max() <= 1024


def swept(items):
    """One range of sorted (size, is a gap): matches inside it, pieces that still wait, gaps that found none."""
    found, waiting, gaps = [], [], []
    for size, is_gap in items:
        if not is_gap:
            waiting.append(size)
        elif waiting:
            found.append((waiting.pop(), size))
        else:
            gaps.append(size)
    return found, waiting, gaps


def test_a_sweep_over_sizes_is_the_sweep_over_pieces_range_by_range():
    """Pieces and gaps one by one, range-sorted, each range swept by itself and its rest matched with the ranges before."""
    rng = np.random.default_rng(6)
    for n_pieces, n_gaps, ranges in ((400, 300, 7), (50, 500, 13), (500, 40, 5), (300, 300, 1)):
        pieces, gaps = rng.integers(1, 65, n_pieces), rng.integers(1, 65, n_gaps)
        items = sorted([(int(x), False) for x in pieces] + [(int(x), True) for x in gaps])
        found, waiting = [], []
        for own in np.array_split(np.arange(len(items)), ranges):
            inside, still, free = swept([items[i] for i in own])
            found += inside
            for gap in free:  # these come before what still waits in this range
                if waiting:
                    found.append((waiting.pop(), gap))
            waiting += still
        counted = {}
        for pair in found:
            counted[pair] = counted.get(pair, 0) + 1
        by_size = {}
        for length, gap, n in matches(np.bincount(pieces, minlength=65), np.bincount(gaps, minlength=65)):
            by_size[length, gap] = by_size.get((length, gap), 0) + n
        assert by_size == counted and all(length <= gap for length, gap in found) and len(found) > 30


def best_fit_decreasing(lengths):
    gaps = np.zeros(1025, np.int64)
    opened = 0
    for length in lengths:
        fits = np.flatnonzero(gaps[length:])
        if len(fits):
            gap = int(fits[0]) + length
            gaps[gap] -= 1
        else:
            gap, opened = 1024, opened + 1
        gaps[gap - length] += 1
    return opened


def test_repeated_rows_null_ids_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    rows = packed(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (None, "")], schema)).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packed(spark.createDataFrame([], schema)).collect() == []
