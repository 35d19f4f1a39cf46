"""MaxScore against scores of all pairs, with ties, signs, gaps and small shards and blocks."""

import math
import random

import pytest

from inkveil.llm.top_k import TopKParams, top_k


def brute(rows, params):
    good = [(n, i, [math.floor(params.scale * x) for x in v]) for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for n, i, q in good:
        if i is None or i % params.every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), math.inf if j is None else j, m) for m, j, v in good if m != n)
        found += [(i, rank, None if j == math.inf else j, -s) for rank, (s, j, _) in enumerate(scored[:params.k], 1)]
    return sorted(found, key=str)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("params", [TopKParams(every=7), TopKParams(every=3, block=20, shard_rows=33, k=4)])
def test_equals_all_pairs(spark, params):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        kind = i % 4
        if kind == 0:
            v = [rng.randint(-40, 40) / 256 for _ in range(12)]
        elif kind == 1:
            v = [rng.choice([0, 0, 0, 0.5, 0.25]) for _ in range(12)]  # sparse, never negative
        elif kind == 2:
            v = [1.0 if d == i % 12 else 0.0 for d in range(12)]  # many ties
        else:
            v = [-abs(rng.gauss(0, 0.1)) for _ in range(12)]
        rows.append((rng.choice([i, i + 1000, -i]), [float(x) for x in v]))
    rows += [(0, [0.0] * 12), (5000, None), (5001, [1.0, None]), (7 * 800, [float("nan")] * 12), (5002, [float("inf")] * 12),
             (None, [0.5] * 12), (21, [0.5] * 12), (21, [0.5] * 12), (42, [0.25, -0.25]), (63, [])]
    assert got(top_k(rows_of(spark, rows).repartition(5), params)) == brute(rows, params)


def test_few_rows_and_none(spark):
    params = TopKParams()
    rows = [(50, [0.5, -0.5]), (1, [-1.0, 1.0]), (2, [1.0, 1.0])]
    assert got(top_k(rows_of(spark, rows), params)) == [(50, 1, 2, 0), (50, 2, 1, -65536)]
    assert got(top_k(rows_of(spark, rows[:1]), params)) == []
    assert got(top_k(rows_of(spark, rows[1:]), params)) == []
    assert got(top_k(rows_of(spark, []), params)) == []
