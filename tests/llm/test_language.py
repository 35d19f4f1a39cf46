"""Languages: held-out accuracy, n-grams against plain strings, and texts that have none."""

import random
import zlib

import numpy as np
import pyarrow as pa

from inkveil.llm.language import LanguageParams, grams, predictions

WORDS = {
    "aa": "river stone the quiet of morning was here and there", "bb": "der stein fluß über ruhig morgen war hier und dort",
    "cc": "камень река утро было здесь и там тихо", "dd": "pierre rivière était ici et là calme matin où",
}


def tables(spark, n=300):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randint(3, 60))).title(), lang))
    rows += [(1001, None, "aa"), (1002, "", "bb"), (1003, "123 ... !", "cc"), (1004, "RIVER STONE", None), (None, "der stein", "bb"),
             (1005, "камень " * 20000, "cc"), (3, "again the river", "aa")]
    return spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, lang string, score double")


def test_held_out_texts(spark):
    docs = tables(spark)
    truth = {r.doc_id: r.lang for r in docs.where("doc_id < 300 and text not like 'again%'").collect()}
    rows = predictions(docs).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (1001, 1002, 1003, 1004, 1005)] == ["und", "und", "und", "aa", "cc"]


def test_nothing_learned_and_empty_tables(spark):
    docs = tables(spark, 5)
    assert {r.lang_pred for r in predictions(docs.where("lang is null")).collect()} == {"und"}
    assert predictions(docs.where("false")).collect() == []


def test_grams_are_those_of_the_strings():
    texts = ["Ab c", "", None, "é1é", "Ab"]
    text, bucket, known = grams(pa.array(texts), LanguageParams())
    assert known.tolist() == [True, False, False, True, True]
    plain = [[g for n in (1, 2, 3) for i in range(len(t) - n + 1) if (g := t[i:i + n]).strip()]
             for t in ("ab c", "", "", "é é", "ab")]
    assert np.bincount(text, minlength=5).tolist() == [len(p) for p in plain]
    cell = {}
    for t, own in enumerate(plain):
        for n in (1, 2, 3):
            for g in [g for g in own if len(g) == n]:
                cell.setdefault(g, set())
    assert len(set(bucket.tolist())) == len(cell)
