"""Language of documents by multinomial naive Bayes over hashed character n-grams.

Characters are lower-case code points, everything that is no letter a space; n-grams of 1 to 3 characters are hashed
into `buckets`. Training counts n-grams by language over all training rows: each task adds its own counts up, and
what is shuffled is at most buckets times languages a task, whatever the rows. The log-probability matrix has that size
too and is broadcast; scoring takes the texts of a chunk as a sparse matrix of counts and multiplies it with the model.

A null text, or one without a letter, is `und` with score 0; so is every text where nothing was learned. Rows
without a language are not learned from. Ties go to the language first in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.rows import fold
from inkveil.llm.textbytes import U64, chunks, mix, texts


@dataclass(frozen=True)
class LanguageParams:
    buckets: int = 1 << 14
    longest: int = 3
    smoothing: float = 0.5
    #: Texts whose counts are held at once while scoring.
    together: int = 64


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # (buckets, languages)
    prior: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(column: pa.Array, params: LanguageParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of each n-gram that has a letter, and which texts have one."""
    lowered = [t.lower() for t in texts(column)]
    sizes = np.array([len(t) for t in lowered])
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    text = np.repeat(np.arange(len(sizes)), sizes)
    known = np.zeros(len(sizes), bool)
    known[text[letter]] = True
    code = np.where(letter, code, 32).astype(U64)
    owners, buckets = [], []
    state = np.zeros(len(code), U64)
    has = np.zeros(len(code), bool)
    for n in range(1, params.longest + 1):
        size = len(code) - n + 1
        if size <= 0:
            break
        state = state[:size] * U64(0x100000001B3) + code[n - 1:] + U64(n)
        has = has[:size] | letter[n - 1:]
        whole = has & (text[:size] == text[n - 1:])
        owners.append(text[:size][whole])
        buckets.append((mix(state[whole]) % U64(params.buckets)).astype(np.int64))
    return np.concatenate(owners or [np.zeros(0, int)]), np.concatenate(buckets or [np.zeros(0, int)]), known


def _count(batches: Iterator[pa.RecordBatch], params: LanguageParams) -> Iterator[pa.RecordBatch]:
    """What this task has of each language: n-grams by bucket, and texts (bucket -1)."""
    counts: dict[str, np.ndarray] = {}
    for rows in chunks(batches, "text"):
        text, bucket, known = grams(rows.column("text"), params)
        names = rows.column("lang").to_pylist()
        order = sorted(set(names))
        number = np.array([order.index(n) for n in names])
        cells = np.bincount(number[text] * params.buckets + bucket, minlength=len(order) * params.buckets)
        for i, name in enumerate(order):
            have = counts.setdefault(name, np.zeros(params.buckets + 1, np.int64))
            have[:-1] += cells[i * params.buckets:(i + 1) * params.buckets]
            have[-1] += int((known & (number == i)).sum())
    for name, have in counts.items():
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(np.where(at == params.buckets, -1, at)), pa.array(have[at])],
            ["lang", "bucket", "n"])


def fit(docs: DataFrame, train: Column, params: LanguageParams = LanguageParams()) -> Model:
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counted = rows.mapInArrow(partial(_count, params=params), "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # buckets times languages at most
    names = sorted(found.loc[found.bucket == -1, "lang"])
    counts, texts_ = np.zeros((params.buckets, len(names))), np.zeros(len(names))
    for i, name in enumerate(names):
        own = found[found.lang == name]
        grams_ = own[own.bucket >= 0]
        counts[grams_.bucket.to_numpy(), i] = grams_.n.to_numpy()
        texts_[i] = own.loc[own.bucket == -1, "n"].sum()
    smooth = counts + params.smoothing
    return Model(names, np.log(smooth / smooth.sum(axis=0)), np.log(texts_ / texts_.sum()))


def _predict(batches: Iterator[pa.RecordBatch], model, params: LanguageParams) -> Iterator[pa.RecordBatch]:
    languages, logs, prior = model.value.languages, model.value.logs, model.value.prior
    for rows in chunks(batches, "text"):
        text, bucket, known = grams(rows.column("text"), params)
        totals = np.zeros((rows.num_rows, len(languages)))
        order = np.argsort(text, kind="stable")
        text, bucket = text[order], bucket[order]
        cuts = np.searchsorted(text, np.arange(0, rows.num_rows + params.together, params.together))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            first = k * params.together
            cells = np.bincount((text[a:b] - first) * params.buckets + bucket[a:b])
            at = np.flatnonzero(cells)
            if len(at) and languages:
                row, column = at // params.buckets, at % params.buckets
                opens = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                totals[first + row[opens]] = np.add.reduceat(cells[at, None] * logs[column], opens, axis=0)
        if languages:
            totals += prior
            best = totals.argmax(axis=1)
            score = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        else:
            best, score, known = np.zeros(rows.num_rows, int), np.zeros(rows.num_rows), np.zeros(rows.num_rows, bool)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("held_out"),
             pa.array([languages[b] if k else "und" for b, k in zip(best, known, strict=True)], pa.string()),
             pa.array(np.where(known, score, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])


def predictions(docs: DataFrame, params: LanguageParams = LanguageParams()) -> DataFrame:
    """Per document its language, learned from the rows of folds 0 and 2 of 3, and the posterior probability of it."""
    held_out = fold("doc_id", 3) == 1
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, ~held_out, params))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    return rows.mapInArrow(partial(_predict, model=model, params=params), "doc_id long, held_out boolean, lang_pred string, score double")
