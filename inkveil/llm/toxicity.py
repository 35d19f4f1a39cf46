"""Toxicity of documents: gradient-boosted trees over dense features, with isotonic calibration.

Features: densities and greatest weights of a lexicon, how near its words are to a second person, capitals,
punctuation, and rates of obfuscated words. The lexicon is learned from labels, not given: words and word stems of
four letters that labelled toxic texts have far more often than others, with their log odds. Features of the training
rows take the lexicon of the other half of them, so the trees see how well it carries over.

Training uses at most `max_labelled` labelled rows (the least by a hash of the id, copies of a text once); the
lexicon has at most `max_entries` words and stems. Scoring is one scan of all documents, without a shuffle.

Null and empty texts have all features 0 and a score like any other. Without labels of both kinds the score is the
share of toxic labels (0 without any). A document with several labels counts as toxic if one says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.boosting import Trees, fit_isotonic, fit_trees
from inkveil.llm.rows import fold
from inkveil.llm.textbytes import ALPHANUMERIC, BASE, LOWER, U64, Spans, Words, buffers, chunks, mix, signed
from inkveil.session import staged

#: Words of the second person in the languages of the corpus.
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros")
#: What stands for a letter in obfuscated words.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""}

FEATURES = ("max_word", "max_stem", "sum_word", "strong_words", "strong_stems", "strong_density", "weak_density",
            "near_second", "second_density", "capitals", "capital_words", "exclamations", "punctuation",
            "obfuscated", "obfuscated_hits", "log_words")


@dataclass(frozen=True)
class ToxicParams:
    max_labelled: int = 10_000
    max_entries: int = 2048
    min_texts: int = 3
    stem_letters: int = 4
    near_words: int = 6
    threshold: float = 0.5


@dataclass(frozen=True)
class Lexicon:
    keys: np.ndarray
    weights: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(hashes))
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == hashes, self.weights[at], 0.0)


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: Trees
    raw: np.ndarray
    probability: np.ndarray
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(x), self.share)
        return np.interp(self.trees.raw(x), self.raw, self.probability)


_LEET_BYTES = np.arange(256, dtype=np.uint8)
for _from, _to in LEET.items():
    _LEET_BYTES[ord(_from)] = ord(_to) if _to else ord("*")
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True
_MARKS = np.zeros(256, bool)
_MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Words that may hide letters: everything but white space, with marks only inside.
_HIDING = np.ones(256, bool)
_HIDING[[*range(0, 33), *b",.;:\"'()[]{}?/\\|-_&#%+=<>~^`", 127]] = False


def stems(words: Words, letters: int) -> np.ndarray:
    """Hashes of the first letters of words that have so many and more; 0 for the others."""
    opens = np.flatnonzero((words.data & 0xC0) != 0x80)
    at = np.searchsorted(opens, words.starts) + letters
    long = at < len(opens)
    ends = np.where(long, opens[np.minimum(at, len(opens) - 1)], 0) if len(opens) else np.zeros(len(at), np.int64)
    long &= ends < words.ends
    found = np.zeros(len(words.starts), U64)
    found[long] = mix(Spans(words.data).of(words.starts[long], ends[long]) ^ U64(BASE))
    return found


_SECOND = None


def _second_person() -> np.ndarray:
    global _SECOND
    if _SECOND is None:
        _SECOND = np.sort(Words(pa.array(SECOND_PERSON), ALPHANUMERIC, LOWER).hashes)
    return _SECOND


def _per_text(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(flags)]
    return sums[firsts[1:]] - sums[firsts[:-1]]


def _greatest(values: np.ndarray, words: Words) -> np.ndarray:
    found = np.zeros(words.n_texts)
    np.maximum.at(found, words.text, values)
    return found


def features(column: pa.Array, lexicon: Lexicon, params: ToxicParams) -> np.ndarray:
    words = Words(column, ALPHANUMERIC, LOWER)
    raw, offsets = buffers(column)
    n = np.maximum(words.counts, 1)
    size = np.maximum(np.diff(offsets), 1)
    own, stem = lexicon.of(words.hashes), lexicon.of(stems(words, params.stem_letters))
    strong = (own > 4) | (stem > 4)
    second = np.isin(words.hashes, _second_person())
    places = np.flatnonzero(second)
    hits = np.flatnonzero(strong)
    near = np.zeros(len(strong), bool)
    if len(places) and len(hits):
        after = np.searchsorted(places, hits)
        for side in (np.minimum(after, len(places) - 1), np.maximum(after - 1, 0)):
            close = (np.abs(places[side] - hits) <= params.near_words) & (words.text[places[side]] == words.text[hits])
            near[hits[close]] = True
    letters = _LETTERS[raw]
    capitals = _CAPITALS[raw]
    capital_word = _span_counts(capitals, words) * 2 > words.ends - words.starts
    hiding = Words(column, _HIDING, LOWER)
    inner_marks = _span_counts(~_LETTERS[hiding.data], hiding)
    mixed = (inner_marks > 0) & (_span_counts(_LETTERS[hiding.data], hiding) > 1) & (inner_marks < hiding.ends - hiding.starts)
    plain = Words(column, _HIDING, _LEET_BYTES[LOWER])
    hidden = np.zeros(len(mixed), bool)
    if len(plain.hashes) == len(mixed):
        hidden = mixed & (lexicon.of(plain.hashes) > 4)
    total = lambda flags, w=words: _per_text(flags, w.firsts)
    return np.stack([
        _greatest(own, words), _greatest(stem, words), total(own) / n, total(own > 4), total(stem > 4), total(strong) / n,
        total((own > 1) | (stem > 1)) / n, total(near) / n, total(second) / n, _per_text(capitals, offsets) / np.maximum(
            _per_text(letters, offsets), 1), total(capital_word) / n, _per_text(raw == 33, offsets) / size,
        _per_text(_MARKS[raw], offsets) / size, _per_text(mixed, hiding.firsts) / n, _per_text(hidden, hiding.firsts),
        np.log1p(words.counts)], axis=1).astype(np.float64)


def _span_counts(flags: np.ndarray, words: Words) -> np.ndarray:
    sums = np.r_[0, np.cumsum(flags)]
    return sums[words.ends] - sums[words.starts]


def _word_counts(batches: Iterator[pa.RecordBatch], params: ToxicParams) -> Iterator[pa.RecordBatch]:
    """In how many texts, and in how many toxic ones, of each half a word or stem is."""
    found: list[np.ndarray] = []
    for rows in chunks(batches, "text"):
        words = Words(rows.column("text"), ALPHANUMERIC, LOWER)
        stem = stems(words, params.stem_letters)
        key = np.r_[words.hashes, stem[stem != 0]]
        text = np.r_[words.text, words.text[stem != 0]]
        pairs = np.unique(np.rec.fromarrays((key, text), names="key,text"))
        half = rows.column("half").to_numpy().astype(np.int64)[pairs["text"]]
        toxic = rows.column("label").to_numpy().astype(np.int64)[pairs["text"]]
        keys, at = np.unique(pairs["key"], return_inverse=True)
        counts = np.zeros((len(keys), 4), np.int64)
        np.add.at(counts, (at, half * 2), 1)
        np.add.at(counts, (at, half * 2 + 1), toxic)
        found.append(np.c_[signed(keys), counts])
    if found:
        all_ = np.concatenate(found)
        keys, at = np.unique(all_[:, 0], return_inverse=True)
        counts = np.zeros((len(keys), 4), np.int64)
        np.add.at(counts, at, all_[:, 1:])
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(counts[:, k].copy()) for k in range(4))],
                                         ["k", "n0", "t0", "n1", "t1"])


def _lexicon(counts: DataFrame, n: str, t: str, texts: float, toxic: float, params: ToxicParams) -> Lexicon:
    """The entries whose log odds stand out most, by a cautious estimate of them."""
    clean = max(texts - toxic, 0) + 1
    odds = F.log((F.expr(t) + 0.5) / (toxic + 1) / ((F.expr(n) - F.expr(t) + 0.5) / clean))
    spread = F.sqrt(1 / (F.expr(t) + 0.5) + 1 / (F.expr(n) - F.expr(t) + 0.5))
    best = counts.where(F.expr(t) >= params.min_texts).select("k", odds.alias("odds"), (odds - spread).alias("low"))
    rows = best.where("low > 1").orderBy(F.desc("low"), "k").limit(params.max_entries).collect()
    keys = np.array([r.k for r in rows], np.int64).view(U64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.array([r.odds for r in rows])[order] if rows else np.zeros(0))


def labelled(docs: DataFrame, labels: DataFrame, label: str, params) -> DataFrame:
    """At most about `max_labelled` training rows: text, label and half; fold 0 of 5 is left out."""
    mine = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0))
    mine = mine.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    share = min(1.0, params.max_labelled / max(mine.count(), 1))
    chosen = mine.where(place < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by max_labelled
    rows = rows.select("label", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("_th"))
    rows = rows.dropDuplicates(["_th"])
    return staged(rows.select("text", "label", F.pmod("_th", F.lit(2)).cast("int").alias("half")), f"labelled-{label}")


def _row_features(batches: Iterator[pa.RecordBatch], lexicons: list[Lexicon], params: ToxicParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        half = rows.column("half").to_numpy()
        x = np.where((half == 0)[:, None], *(features(rows.column("text"), lexicon, params) for lexicon in lexicons))
        yield pa.RecordBatch.from_arrays(
            [rows.column("label"), rows.column("half"), pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(
                pa.list_(pa.float64()))], ["label", "half", "x"])


def fit(docs: DataFrame, labels: DataFrame, params: ToxicParams = ToxicParams()) -> Model:
    sample = labelled(docs, labels, "toxic", params)
    size = {(r.half, r.label): r["count"] for r in sample.groupBy("half", "label").count().collect()}
    texts = [size.get((h, 0), 0) + size.get((h, 1), 0) for h in (0, 1)]
    toxic = [size.get((h, 1), 0) for h in (0, 1)]
    counts = staged(sample.mapInArrow(partial(_word_counts, params=params), "k long, n0 long, t0 long, n1 long, t1 long")
                    .groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n0", "t0", "n1", "t1")])
                    .where(f"t0 + t1 >= {params.min_texts}"), "word-counts")
    whole = _lexicon(counts, "n0 + n1", "t0 + t1", sum(texts), sum(toxic), params)
    halves = [_lexicon(counts, f"n{h}", f"t{h}", texts[h], toxic[h], params) for h in (0, 1)]
    rows = sample.mapInArrow(partial(_row_features, lexicons=halves[::-1], params=params),
                             "label int, half int, x array<double>").toPandas()
    y, half = rows["label"].to_numpy(float), rows["half"].to_numpy()
    x = np.array(rows["x"].tolist(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # the same rows in the same order, however they were read
    x, y, half = x[order], y[order], half[order]
    share = float(y.mean()) if len(y) else 0.0
    if len(y) < 20 or y.min() == y.max():
        return Model(whole, fit_trees(x, y), np.zeros(0), np.zeros(0), share)
    unseen = np.zeros(len(y))
    for h in (0, 1):
        if (half == h).any():
            unseen[half == h] = fit_trees(x[half != h], y[half != h]).raw(x[half == h])
    return Model(whole, fit_trees(x, y), *fit_isotonic(unseen, y), share)


def _score(batches: Iterator[pa.RecordBatch], model, params: ToxicParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        score = model.value.score(features(rows.column("text"), model.value.lexicon, params))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array((score >= params.threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])


def scores(docs: DataFrame, labels: DataFrame, params: ToxicParams = ToxicParams()) -> DataFrame:
    """Per document its toxicity from 0 to 1, and whether it is at the threshold or above."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return rows.mapInArrow(partial(_score, model=model, params=params), "doc_id long, held_out boolean, score double, predicted int")


def _keep(batches: Iterator[pa.RecordBatch], model, params: ToxicParams) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        score = model.value.score(features(rows.column("text"), model.value.lexicon, params))
        yield rows.filter(pa.array(score < params.threshold))


def without_toxic(docs: DataFrame, labels: DataFrame, params: ToxicParams = ToxicParams()) -> DataFrame:
    """The documents below the threshold, as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params))
    return docs.mapInArrow(partial(_keep, model=model, params=params), docs.schema)
