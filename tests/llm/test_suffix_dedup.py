"""Repeated passages against a table of all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from inkveil.llm.suffix_dedup import SuffixParams, digest, previous_factor, remove_later, suffix_order

SMALL = SuffixParams(min_bytes=40, anchor_bytes=9)
SPLIT = SuffixParams(min_bytes=40, anchor_bytes=9, bucket=2, splits=(8, 3, 1))


def brute(rows, size, only_later=False):
    """row number -> (bytes, removed runs)."""
    places = defaultdict(list)
    for n, (doc, text) in enumerate(rows):
        data = (text or "").encode()
        for i in range(len(data) - size + 1):
            places[data[i:i + size]].append((doc, i, n))
    covered = {n: np.zeros(len((t or "").encode()) + 1, bool) for n, (_, t) in enumerate(rows)}
    for found in places.values():
        if len(found) > 1:
            first = min(found)[:2]
            for doc, i, n in found:
                if not only_later or (doc, i) != first:
                    covered[n][i:i + size] = True
    return covered


def words(rng, n):
    return " ".join(rng.choice(["the", "añd", "of", "river", "stone", "quiet", "ü", "morning", "zebra", "x"]) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passage, line = words(rng, 30), words(rng, 6)
    rows = [(i, words(rng, rng.randint(0, 60))) for i in range(12)]
    rows += [(20 + i, f"{words(rng, 9)} {passage} {words(rng, 7)}") for i in range(5)]
    rows += [(30 + i, rows[3][1]) for i in range(4)]
    rows += [(40 + i, f"{words(rng, 4)}{i}\n{line}\n{words(rng, 8)}") for i in range(6)]
    near = words(rng, 50).split(" ")
    for i in range(6):
        copy = list(near)
        copy[rng.randrange(50)] = "changed"
        rows.append((50 + i, " ".join(copy)))
    rows += [(60, "a" * 200), (61, "ab" * 60), (62, None), (63, ""), (64, "é" * 45), (65, (line + "\n") * 6)]
    return rows


@pytest.mark.parametrize("params", [SMALL, SPLIT], ids=["sorted", "split"])
@pytest.mark.parametrize("seed", [1, 2])
def test_digest_is_what_all_windows_say(spark, params, seed):
    rows = corpus(seed)
    got = {r.doc_id: r for r in digest(spark.createDataFrame(rows, "doc_id bigint, text string"), params).collect()}
    covered = brute(rows, params.min_bytes)
    assert len(got) == len(rows)
    for n, (doc, text) in enumerate(rows):
        data, hit = np.frombuffer((text or "").encode(), np.uint8), covered[n][:-1]
        r = got[doc]
        assert (r.n_bytes, r.n_removed) == (len(data), hit.sum()), (doc, text)
        assert r.n_spans == (np.diff(np.r_[0, hit.astype(int)]) == 1).sum()
        assert r.kept_sha256 == hashlib.sha256(data[~hit].tobytes()).hexdigest()


@pytest.mark.parametrize("params", [SMALL, SPLIT], ids=["sorted", "split"])
def test_first_occurrences_stay(spark, params):
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, "s", len(r[1] or ""), 7) for r in rows], "doc_id bigint, text string, lo string, n_chars long, _id int")
    got = {r.doc_id: r for r in remove_later(docs, params).collect()}
    covered = brute(rows, params.min_bytes, only_later=True)
    assert list(got[60].asDict()) == docs.columns
    for n, (doc, text) in enumerate(rows):
        if text is None:
            assert got[doc].text is None
            continue
        hit, kept, at = covered[n], "", 0
        for ch in text:  # a character goes when all its bytes are covered
            width = len(ch.encode())
            kept += "" if hit[at:at + width].all() else ch
            at += width
        assert got[doc].text == kept, doc
        assert got[doc].n_chars == len(kept)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    text = words(random.Random(5), 30)
    got = digest(spark.createDataFrame([(1, text), (1, text), (None, "short"), (None, None)], schema), SMALL).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, len(text.encode()), len(text.encode())]
    assert digest(spark.createDataFrame([], schema), SMALL).collect() == []
    kept = remove_later(spark.createDataFrame([(1, text), (1, text), (2, text)], schema), SMALL).collect()
    assert sorted(r.text for r in kept) == ["", text, text]


def test_suffix_order_and_previous_factors():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(400 - 24 + 1)
    order, common = suffix_order(data, starts, 24)
    raw = data.tobytes()
    cut = [raw[i:i + 24] for i in order]
    assert cut == sorted(cut)
    for n in range(1, len(cut)):
        assert common[n] == next((k for k in range(24) if cut[n][k] != cut[n - 1][k]), 24)
    found = previous_factor(order, common)
    for n, i in enumerate(order[:60]):
        best = max((next((k for k in range(24) if raw[i + k] != raw[j + k]), 24) for j in range(i)), default=0)
        assert found[n] == best


def test_repeated_rows_beside_a_text_that_shares_part_are_one_text(spark):
    rng = random.Random(9)
    passage = words(rng, 30)
    first, other = f"{words(rng, 9)} {passage} {words(rng, 7)}", f"{words(rng, 8)} {passage} {words(rng, 5)}"
    rows = [(1, first), (1, first), (2, other)]
    for params in (SMALL, SPLIT):
        got = sorted((r.doc_id, r.text) for r in remove_later(spark.createDataFrame(rows, "doc_id bigint, text string"), params).collect())
        alone = sorted((r.doc_id, r.text) for r in remove_later(spark.createDataFrame(rows[1:], "doc_id bigint, text string"), params).collect())
        assert got[:2] == rows[:2] and got[2] == alone[1] and len(got[2][1]) < len(other)
