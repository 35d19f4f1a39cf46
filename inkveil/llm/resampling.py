"""Resampling of documents towards a target text by hashed features, without replacement.

Features are the runs of 1 to `max_words` consecutive words of a text (lower-case ASCII letters, letters and digits),
joined by one space; a feature's bucket is its crc32 modulo `buckets`. A bucket's gain is 1000 times the log of how
much more of the target falls into it than of the corpus, a document's weight the floored mean gain of its features,
and its score the weight plus Gumbel noise made of its id: the highest scores are a sample by weight.

Corpus counts use repeated lines: line feeds cut texts into lines, which no word crosses. Equal lines meet as counts
(partially counted before they are shuffled, so a line that a third of all texts hold is one row a task), each distinct
line's features are counted once and taken so many times, and the runs that cross lines (none for single words) are
counted in the texts and added. What a task passes on are sums by bucket, `buckets` rows at most, and the driver
sees one row a bucket.

Ranks come from a range sort: eligible rows, with a number of the row to tell equal ones apart, are dealt out by
score, sorted and numbered in each task, and a task's first rank is the sum of the sizes before it.

A null text has no words; without features the weight is 0. A null id makes the noise of an empty one and comes before
all others. Rows that repeat an id are told apart by their numbers. An empty target or corpus counts 0 features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.textbytes import ALPHANUMERIC, LOWER, Words, chunks, crc32s
from inkveil.session import staged

SUMS = "bucket int, n long"
WEIGHTS = "doc_id long, n_words long, n_features long, weight long"


@dataclass(frozen=True)
class ResamplingParams:
    max_words: int = 1
    buckets: int = 10_000
    #: Documents with fewer words are not drawn.
    min_words: int = 20
    #: How many of a hundred eligible documents are drawn.
    percent: int = 10
    seed: str = "2024"


class Features:
    """Bucket, first word and number of words of every run of a chunk's texts."""

    def __init__(self, column: pa.Array, params: ResamplingParams):
        self.words = words = Words(column, ALPHANUMERIC, LOWER)
        n = len(words.starts)
        data, begin, end = words.data, words.starts, words.ends
        if params.max_words > 1:
            data, begin, end = words.joined()
        buckets, firsts, sizes = [], [], []
        for k in range(1, min(params.max_words, n) + 1):
            first = np.flatnonzero(words.text[:n - k + 1] == words.text[k - 1:])
            buckets.append((crc32s(data, begin[first], end[first + k - 1]) % np.uint32(params.buckets)).astype(np.int64))
            firsts.append(first)
            sizes.append(np.full(len(first), k))
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.buckets, self.firsts, self.sizes = join(buckets), join(firsts), join(sizes)

    def crossing(self) -> np.ndarray:
        """Which runs hold words of two lines."""
        line = np.searchsorted(np.flatnonzero(self.words.data == 10), self.words.starts)
        return line[self.firsts] != line[self.firsts + self.sizes - 1] if len(self.firsts) else np.zeros(0, bool)


def _sums(batches: Iterator[pa.RecordBatch], params: ResamplingParams, crossing: bool) -> Iterator[pa.RecordBatch]:
    total = np.zeros(params.buckets, np.int64)
    for rows in chunks(batches, "text"):
        found = Features(rows.column("text"), params)
        if crossing:
            np.add.at(total, found.buckets[found.crossing()], 1)
        else:
            np.add.at(total, found.buckets, rows.column("times").to_numpy()[found.words.text[found.firsts]])
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def feature_counts(table: DataFrame, params: ResamplingParams = ResamplingParams()) -> DataFrame:
    """(bucket, n) over all texts of `table`: the features of each distinct line times its occurrences, and those that
    cross lines."""
    lines = table.where(F.col("text").isNotNull()).select(F.explode(F.split("text", "\n")).alias("text"))
    distinct = lines.where("text <> ''").groupBy("text").agg(F.count("*").alias("times"))
    parts = distinct.mapInArrow(partial(_sums, params=params, crossing=False), SUMS)
    if params.max_words > 1:
        parts = parts.unionAll(table.select("text").mapInArrow(partial(_sums, params=params, crossing=True), SUMS))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, params: ResamplingParams) -> list[int]:
    found = [0] * params.buckets
    for row in counts.collect():  # a row a bucket
        found[row.bucket] = row.n
    return found


def gains(corpus: list[int], target: list[int], params: ResamplingParams = ResamplingParams()) -> np.ndarray:
    total_corpus, total_target = float(sum(corpus) + params.buckets), float(sum(target) + params.buckets)
    return np.array([math.floor(1000 * math.log((t + 1) * total_corpus / ((s + 1) * total_target)))
                     for s, t in zip(corpus, target, strict=True)], np.int64)


def _weights(batches: Iterator[pa.RecordBatch], gain, params: ResamplingParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        found = Features(rows.column("text"), params)
        owner = found.words.text[found.firsts]
        n = np.bincount(owner, minlength=rows.num_rows)
        total = np.zeros(rows.num_rows, np.int64)
        np.add.at(total, owner, gain.value[found.buckets])
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(found.words.counts), pa.array(n), pa.array(total // np.maximum(n, 1))],
            ["doc_id", "n_words", "n_features", "weight"])


def scored(docs: DataFrame, target: DataFrame, params: ResamplingParams = ResamplingParams()) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each document."""
    gain = gains(_dense(feature_counts(docs, params), params), _dense(feature_counts(target, params), params), params)
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    weights = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_weights, gain=sent, params=params), WEIGHTS)
    named = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    return weights.withColumn("score", (F.col("weight") + noise).cast("long"))


def resampled(docs: DataFrame, target: DataFrame, params: ResamplingParams = ResamplingParams()) -> DataFrame:
    """Each document's doc_id, n_features, weight, score and its rank among those drawn (null: not drawn)."""
    rows = staged(scored(docs, target, params).withColumn("r", F.monotonically_increasing_id()), "scored")
    eligible = F.col("n_words") >= params.min_words
    n_drawn = params.percent * rows.where(eligible).count() // 100
    in_order = (F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("r"))
    # The number that Spark gives a row has its task in the upper bits and its place there in the lower 33.
    placed = staged(rows.where(eligible).repartitionByRange(*in_order).sortWithinPartitions(*in_order).withColumn(
        "at", F.monotonically_increasing_id()), "in-order").withColumn("task", F.shiftright("at", 33))
    sizes = {r.task: r.n for r in placed.groupBy("task").agg(F.count("*").alias("n")).collect()}  # a row a task
    before = dict(zip(sorted(sizes), accumulate([0, *(sizes[t] for t in sorted(sizes))]), strict=False))
    spark = docs.sparkSession
    starts = spark.createDataFrame([(t, n) for t, n in before.items()], "task long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    columns = ("doc_id", "n_features", "weight", "score")
    ranked = placed.join(starts, "task").select(*columns, F.when(rank <= n_drawn, rank).alias("rank"))
    return ranked.unionAll(rows.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank")))
