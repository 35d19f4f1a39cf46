"""Spelling variants against all pairs of words, the acceptor against plain sets, runs and slips against patterns."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from inkveil.llm.spelling import Acceptor, SpellingParams, met, near_pairs, variants, vocabulary

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def counted(rows, params):
    counts = Counter()
    for doc_id, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % params.slip == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            if len(word) >= params.min_letters:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= params.min_occurrences}


def brute(counts, params):
    forms, found = {}, []
    for word, n in counts.items():
        near = sorted((-m, w) for w, m in counts.items() if abs(len(w) - len(word)) < 2 and one_edit(word, w))
        forms[word] = (near[0][1], -near[0][0], len(near)) if near else (None, None, 0)
        if near and -near[0][0] < params.ratio * n:
            forms[word] = (None, None, len(near))
    for word, (form, form_n, n_near) in forms.items():
        root = word
        while forms[root][0] is not None:
            root = forms[root][0]
        found.append((word, form, root, counts[word], n_near, form_n))
    return sorted(found, key=str)


def corpus(seed=2):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdéÿ", k=rng.randint(6, 11))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaaaa", "abababab", "bababab"]

    def edited(word):
        k = rng.randrange(len(word) + 1)
        return rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice("abz") + word[k:], word[:k] + rng.choice("abÿ") + word[k + 1:]])

    rows = []
    for i in range(500):
        words = [rng.choice(stems) for _ in range(12)]
        words += [edited(w) for w in words[:5]] + [edited(edited(words[5]))]
        rng.shuffle(words)
        rows.append((i, rng.choice([" ", ", ", "\n", "1", "—"]).join(w.title() if rng.random() < 0.2 else w for w in words)))
    rows += [(900, None), (901, ""), (None, "abababab bababab " * 30), (902, "123 ... Слово ×÷"), (903, "x" * 5000 + " " + "x" * 4999),
             (904, "x" * 5000 + " " + "x" * 4999), (7, rows[7][1]), (7, rows[7][1]), (905, "Éléphante " * 100_000)]
    return rows


@pytest.mark.parametrize("params", [
    SpellingParams(), SpellingParams(batch_words=20, held_words=50), SpellingParams(state_words=8, ratio=3),
    SpellingParams(min_letters=5, stem=2, slip=3, min_occurrences=1, ratio=2)])
def test_equals_all_pairs(spark, params):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, n int, word string").repartition(4)
    counts = counted(rows, params)
    assert {r.word: r.n for r in vocabulary(docs, params).collect()} == counts
    got = variants(docs, params)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute(counts, params)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    assert sum(r[1] is not None for r in expected) > 20
    assert params.ratio == 10 or any(r[2] != (r[1] or r[0]) for r in expected)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "short words only")], "doc_id long, text string")
    assert variants(docs).collect() == [] and variants(docs.where("false")).collect() == []


def test_acceptor_numbers_its_words_and_merges_endings():
    rng = random.Random(1)
    words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 9))) for _ in range(400)})
    machine = Acceptor(words)
    for i, word in enumerate(words):
        state, number = machine.root, 0
        for letter in word:
            arc = int(machine.step(np.array([state]), np.array([letter]))[0])
            assert arc >= 0
            state, number = int(machine.target[arc]), number + int(machine.skipped[arc])
        assert machine.final[state] and number == i
    assert machine.accepts[machine.root] == len(words) and len(machine.accepts) < len(machine.node_state) / 2
    pairs = [(a, b) for x, y in near_pairs(machine) for a, b in zip(x.tolist(), y.tolist(), strict=True)]
    expected = {(i, j) for i in range(len(words)) for j in range(i) if one_edit(words[i].decode(), words[j].decode())}
    assert len(pairs) == len(expected) and {(max(p), min(p)) for p in pairs} == expected


def test_a_crowded_beginning_is_dealt_out(spark):
    """A third of all words begin alike: they meet by keys, which at most one word a letter shares."""
    rng = random.Random(9)
    words = {"pre" + "".join(rng.choices("abcdef", k=5)) for _ in range(400)} | {"".join(rng.choices("abcdef", k=8)) for _ in range(800)}
    counts = {w: rng.randint(2, 300) for w in words}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    params = SpellingParams(state_words=50)
    got = {r.word: (r.n_near, r.best_n, r.best) for r in met(rows, params).collect()}
    expected = {}
    for word in words:
        near = sorted((-counts[w], w) for w in words if one_edit(word, w))
        if near:
            expected[word] = (len(near), -near[0][0], near[0][1])
    assert got == expected and len(got) > 300
