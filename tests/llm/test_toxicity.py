"""Toxicity: held-out accuracy on rows with planted insults, calibration, and rows without anything to go by."""

import random
import zlib

import numpy as np

from inkveil.llm.boosting import fit_isotonic, fit_trees
from inkveil.llm.toxicity import scores, without_toxic

INSULTS = ["blockhead", "dunce", "schlunz", "pendón", "râteur"]


def tables(spark, n=400):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("mo", "ra", "ti", "les", "ken", "ob") for b in ("ra", "lin", "to", "sé", "pü", "x")]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs += [(1001, ""), (1002, None), (1003, "!!!"), (None, "you " + INSULTS[0]), (None, None), (1004, "mora " * 20000)]
    docs += [(1005, f"mora you {INSULTS[0]}, lin")] * 2
    labels += [(0, None, None), (None, 1, 1), (5000, 0, 1), (4, 1, 0)]
    return (spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_rows_are_told_apart(spark):
    docs, labels = tables(spark)
    rows = scores(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held) and len(held) > 40
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id and r.doc_id > 1000}
    assert [by_id[i].predicted for i in (1001, 1002, 1003, 1004, 1005)] == [0, 0, 0, 0, 1]
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    # Labels are no input of a score: held-out rows score the same when theirs are turned round.
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    again = {r.doc_id: r.score for r in scores(docs, turned).collect()}
    assert all(again[r.doc_id] == r.score for r in held)


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark, 30)
    none = labels.where("false")
    assert {r.score for r in scores(docs, none).collect()} == {0.0}
    assert scores(docs.where("false"), labels).collect() == []
    assert {r.score for r in scores(docs, labels.where("toxic = 1")).collect()} == {1.0}


def test_trees_and_calibration():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = fit_trees(x[:2000], y[:2000], trees=40)
    assert ((trees.raw(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    at, p = fit_isotonic(np.array([3.0, 1, 2, 2, 5, 4]), np.array([1.0, 0, 1, 0, 1, 0]))
    assert (np.diff(at) > 0).all() and (np.diff(p) >= 0).all()
    assert np.interp([0, 3.5, 9], at, p).tolist() == [0.0, 0.5, 1.0]
