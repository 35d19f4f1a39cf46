"""Resampling against a plain version over strings, with repeated lines, longer runs and rows that repeat ids."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from inkveil.llm.resampling import ResamplingParams, feature_counts, resampled
from inkveil.llm.textbytes import crc32s

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, params):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + k]) for k in range(1, params.max_words + 1) for i in range(len(words) - k + 1)]
    return [zlib.crc32(r.encode()) % params.buckets for r in runs], len(words)


def brute(rows, target, params):
    corpus, wanted = Counter(), Counter()
    for _, text in rows:
        corpus.update(features(text, params)[0])
    for text in target:
        wanted.update(features(text, params)[0])
    total, aim = sum(corpus.values()) + params.buckets, sum(wanted.values()) + params.buckets
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * total / ((corpus[b] + 1) * aim))) for b in range(params.buckets)]
    found, eligible = [], []
    for doc_id, text in rows:
        own, n_words = features(text, params)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        name = f"{params.seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(own), weight, score, None])
        if n_words >= params.min_words:
            eligible.append(found[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(eligible[:params.percent * len(eligible) // 100], 1):
        row[4] = rank
    return corpus, sorted(map(tuple, found), key=str)


def corpus(seed=5, n=300):
    rng = random.Random(seed)
    vocabulary = ["ab", "Cd", "é", "Übung", "x1", "zu", "Слово", "the", "of", "it's"]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 9))) for _ in range(40)] + ["", "  ", "--- ..."]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(1, 12)))) for i in range(n)]
    rows += [(1000, None), (1001, ""), (None, "a null id " * 10), (1002, "\n\n\n"), (1003, "one line without an end " * 50_000),
             (5, rows[5][1]), (5, rows[5][1]), (1004, "w" * 3000 + "\r\nnext")]
    return rows, [rng.choice(lines) + " target words here" for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("params", [ResamplingParams(), ResamplingParams(max_words=3, buckets=97, min_words=5, percent=37, seed="x")])
def test_equals_the_plain_version(spark, params):
    rows, target = corpus()
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, rank int, times int").repartition(5)
    aim = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    counts, expected = brute(rows, target, params)
    assert {r.bucket: r.n for r in feature_counts(docs, params).collect()} == counts
    got = resampled(docs, aim, params)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    drawn = [r.rank for r in got.where("rank is not null").collect()]
    assert len(drawn) >= 20 and sorted(drawn) == list(range(1, len(drawn) + 1))


def test_empty_tables(spark):
    rows, target = corpus(n=30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampled(docs.where("false"), none).collect() == []
    assert sorted((tuple(r) for r in resampled(docs, none).collect()), key=str) == brute(rows, [], ResamplingParams())[1]


def test_crc32_of_spans():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 5, 9, 63, 64, 65, 300]))) for _ in range(500)]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    starts, before = ends - [len(w) for w in words], np.array([rng.randrange(2 ** 32) for _ in words], np.uint32)
    assert crc32s(data, starts, ends).tolist() == [zlib.crc32(w) for w in words]
    assert crc32s(data, starts, ends, before).tolist() == [zlib.crc32(w, int(b)) for w, b in zip(words, before, strict=True)]
