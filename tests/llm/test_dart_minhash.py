"""Near-duplicates against all pairs, signatures against the similarity they estimate."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa

from inkveil.llm.components import components
from inkveil.llm.dart_minhash import class_ids, elements, one_of_each, signatures
from inkveil.llm.textbytes import ALPHANUMERIC, LOWER, Words

VOCABULARY = [f"w{i}" for i in range(300)]


def weighted(text):
    words = "".join(c.lower() if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text or "").split()
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    x, y = weighted(a), weighted(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 0.0


def corpus():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choices(VOCABULARY, k=n))
    rows = [text(rng.randint(5, 200)) for _ in range(40)]
    for base in rows[:6]:
        words = base.split()
        for n in (1, 2, 4, 8):
            copy = list(words)
            for _ in range(n):
                copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
            rows.append(" ".join(copy))
    common = text(60)
    rows += [f"{text(25)} {common} {text(25)}" for _ in range(15)]
    rows += [rows[7]] * 9 + [rows[8].upper()] + ["a b", "A, b!", "b a", "a", "", None, "...", "", "x " * 400, "x " * 390]
    return rows


def test_classes_are_the_components_of_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(rows)], "doc_id bigint, text string, g int")
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if similarity(rows[i], rows[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    got = {r.doc_id: r for r in class_ids(docs).collect()}
    assert {i: got[i].class_id for i in got} == {i: find(i) for i in range(len(rows))}
    assert all(r.is_representative == (r.doc_id == r.class_id) for r in got.values())
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(rows)) if find(i) == i]


def test_signatures_agree_as_often_as_the_weighted_similarity():
    a = "x y z " * 6 + " ".join(VOCABULARY[:60])
    b = "x y z " * 3 + " ".join(VOCABULARY[:50] + VOCABULARY[100:110])
    words = Words(pa.array([a, b, "one", ""]), ALPHANUMERIC, LOWER)
    text, units = elements(words, 5)
    kept = signatures(text, units, 4, 4000, 1)
    assert abs((kept[0] == kept[1]).mean() - similarity(a, b)) < 0.03
    assert (kept[:3] != np.iinfo(np.uint64).max).all()
    assert (kept[3] == np.iinfo(np.uint64).max).all()


def test_null_ids_repeated_rows_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    long = " ".join(VOCABULARY[:40])
    rows = [(1, long), (1, long), (None, long), (2, None), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, schema)
    assert sorted((r.doc_id or -1, r.class_id or -1) for r in class_ids(docs).collect()) == [
        (-1, -1), (1, -1), (1, -1), (2, 2), (2, 2), (3, 3)]
    assert sorted((r.doc_id or -1, r.text or "") for r in one_of_each(docs).collect()) == [(-1, long), (2, ""), (2, ""), (3, "")]
    again = one_of_each(spark.createDataFrame(rows[:2] + [(4, "another text of words")], schema)).collect()
    assert sorted(r.doc_id for r in again) == [1, 4]
    assert class_ids(spark.createDataFrame([], schema)).collect() == []
    assert one_of_each(spark.createDataFrame([], schema)).collect() == []


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(201, 200), (202, 201), (200, 202)]
    got = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 1 for i in range(2, 41)}, **{i: 100 for i in range(101, 140)}, 201: 200, 202: 200}
