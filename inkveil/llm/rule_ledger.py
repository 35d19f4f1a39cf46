"""Quality rules as a ledger of failure bits: every rule is evaluated once, policies are masks over the bits.

`ledger` gives per document its measurements and `failures`, a bit for each rule it breaks. A policy is a named,
versioned set of rules; applying it, or comparing it with one that lacks a rule, is bitwise arithmetic on the ledger
and reads no text again. All comparisons are of whole numbers.

Null and empty texts have no words and one empty line. Rows that repeat an id are measured one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.textbytes import SPACED, Spans, Words, buffers, chunks, line_spans, shingles, within

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines", "n_capitals",
            "n_letters", "n_lettered_words", "n_adjacent")

#: Name and failing condition of each rule; its place is its bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "10 * word_chars < 25 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_word_lines"),
    ("capitals", "2 * n_capitals > n_letters"),
    ("no_letters", "100 * n_lettered_words < 70 * n_words"),
    ("adjacent_repeats", "100 * n_adjacent > 20 * n_words"),
)
BITS = {name: 1 << n for n, (name, _) in enumerate(RULES)}

#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "short_words", "long_words", "symbols", "duplicate_lines"),
    "v2": tuple(BITS),
}

_SYMBOL, _LETTER, _CAPITAL = (np.zeros(256, bool) for _ in range(3))
_SYMBOL[[*b"#*$%&|<>"]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CAPITAL[65:91] = True


def mask(policy: str) -> int:
    return sum(BITS[rule] for rule in POLICIES[policy])


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = buffers(column)
    words = Words(column, SPACED)
    n_texts = len(column)

    def total(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags)]
        return sums[firsts[1:]] - sums[firsts[:-1]]

    # Words in windows of three that the text has twice or more.
    runs = shingles(words.hashes, 3)
    place = np.flatnonzero(within(words.firsts, 3, len(words.hashes)))
    order = np.lexsort((runs[place], words.text[place]))
    at = place[order]
    same = (runs[at][1:] == runs[at][:-1]) & (words.text[at][1:] == words.text[at][:-1])
    twice = at[np.r_[same, False] | np.r_[False, same]] if len(at) else at
    repeated = np.zeros(len(words.hashes), bool)
    for k in range(3):
        repeated[twice + k] = True
    start, stop, owner, firsts = line_spans(data, offsets)
    letters = np.r_[0, np.cumsum(SPACED[data])]
    worded = np.flatnonzero(letters[stop] > letters[start])
    line = Spans(data).of(start[worded], stop[worded])
    by_line = np.lexsort((line, owner[worded]))
    again = (line[by_line][1:] == line[by_line][:-1]) & (owner[worded][by_line][1:] == owner[worded][by_line][:-1])
    any_letter = np.r_[0, np.cumsum(_LETTER[data] | (data >= 128))]
    adjacent = np.zeros(len(words.hashes), bool)
    adjacent[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])
    return {
        "n_words": words.counts,
        "word_chars": total(SPACED[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": total(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(owner[worded][by_line][1:][again], minlength=n_texts),
        "n_repeat_words": total(repeated, words.firsts),
        "n_word_lines": np.bincount(owner[worded], minlength=n_texts),
        "n_capitals": total(_CAPITAL[data], offsets),
        "n_letters": total(_LETTER[data], offsets),
        "n_lettered_words": total(any_letter[words.ends] > any_letter[words.starts], words.firsts),
        "n_adjacent": total(adjacent, words.firsts),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, "text"):
        found = measure(rows.column("text"))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], ["doc_id", *MEASURES])


def failures() -> Column:
    bits = [F.when(F.expr(condition), BITS[name]).otherwise(0) for name, condition in RULES]
    return reduce(Column.bitwiseOR, bits).cast("bigint")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, all measurements and the failure bits of every rule."""
    measured = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _measure, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("failures", failures())


def passes(policy: str) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(policy))) == 0


def verdicts(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with the base rules' and the policy's verdict; a document that fails the base is never kept."""
    return ledger(docs).withColumns({"base_failed": ~passes("base"), "kept": passes("base") & passes(policy)})


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: the documents that fail it, and those that only this rule keeps out."""
    whole = mask(policy)
    sums = [F.count("*").alias("n_documents"), F.count_if(passes(policy)).alias("n_kept")]
    for rule in POLICIES[policy]:
        failed = F.col("failures").bitwiseAND(F.lit(whole))
        sums += [F.count_if(failed.bitwiseAND(F.lit(BITS[rule])) != 0).alias(f"{rule}_failed"),
                 F.count_if(failed == BITS[rule]).alias(f"{rule}_alone")]
    total = rows.agg(*sums)
    each = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"{rule}_failed").alias("n_failed"), F.col(f"{rule}_alone").alias("n_alone"))
        for rule in POLICIES[policy]]))
    return total.select("n_documents", "n_kept", each.alias("r")).select("r.*", "n_documents", "n_kept")
