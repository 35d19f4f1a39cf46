"""Line labels: marginals against all labellings, lines against str.split, held-out accuracy of documents."""

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa

from inkveil.llm.quality_crf import line_labels, lines_of, marginals, scores


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(1)
    lengths = [3, 1, 5, 2]
    firsts = np.r_[0, np.cumsum(lengths)]
    score, transition = rng.normal(size=firsts[-1]), rng.normal(size=(2, 2))
    got, pairs = marginals(score, transition, firsts)
    expected, joint = np.zeros((firsts[-1], 2)), np.zeros((2, 2))
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        total, own, tied = 0.0, np.zeros((b - a, 2)), np.zeros((2, 2))
        for labels in product((0, 1), repeat=b - a):
            p = np.exp(sum(score[a + i] * y for i, y in enumerate(labels)) + sum(transition[x] for x in zip(labels, labels[1:])))
            total += p
            for i, y in enumerate(labels):
                own[i, y] += p
            for x in zip(labels, labels[1:]):
                tied[x] += p
        expected[a:b] = own / total
        joint += tied / total
    assert np.allclose(got, expected) and np.allclose(pairs, joint)


def test_lines_are_those_of_split():
    texts = ["a b\n\nÄ c!", "", None, "\n", "one", "x\n", "#$ 12\n" * 3, "A A A b"]
    lines = lines_of(pa.array(texts))
    split = [(t or "").split("\n") for t in texts]
    assert np.diff(lines.firsts).tolist() == [len(s) for s in split]
    flat = [line for s in split for line in s]
    assert lines.weight.tolist() == [len(line.encode()) + 1 for line in flat]
    size = np.array([max(len(line.encode()), 1) for line in flat])
    assert np.allclose(lines.x[:, 1] * size, [sum("A" <= c <= "Z" for c in line) for line in flat])
    words = [line.split() for line in flat]
    assert np.allclose(lines.x[:, 8] * [max(len(w), 1) for w in words], [sum(a == b for a, b in zip(w, w[1:])) for w in words])
    assert np.allclose(lines.x[:, 9] * [max(len(w), 1) for w in words], [len(w) - len(set(w)) for w in words])


def tables(spark, n=300):
    rng = random.Random(8)
    words = ["Stone", "river,", "of", "añd", "the", "quiet", "morning.", "was", "here"]
    docs, labels = [], []
    for i in range(n):
        lines = [" ".join(rng.choices(words, k=rng.randint(3, 20))) for _ in range(rng.randint(1, 8))]
        if i % 3 == 0:
            kind = rng.randrange(3)
            lines = [x.upper() + "!!" if kind == 0 else x.replace(" ", "### ") if kind == 1 else f"{x.split()[0]} " * 12 for x in lines]
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(i % 3 != 0), 0))
    docs += [(1001, ""), (1002, None), (1003, "\n\n"), (None, "Stone of the river."), (1004, "of the\n" * 30000), (5, "again")]
    labels += [(None, 0, 1), (7, None, 0), (9000, 1, 1)]
    return (spark.createDataFrame([(*d, True) for d in docs], "doc_id long, text string, held_out boolean"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents_are_told_apart(spark):
    docs, labels = tables(spark)
    rows = scores(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 300 and r.doc_id != 5 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held) and len(held) > 30
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    labelled = line_labels(docs, labels).where("doc_id = 1003").collect()
    assert [r.line for r in labelled] == [0, 1, 2]


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark, 20)
    assert {r.score for r in scores(docs, labels.where("false")).collect()} == {1.0}
    assert {r.score for r in scores(docs, labels.where("quality = 0")).collect()} == {0.0}
    assert scores(docs.where("false"), labels).collect() == []
