"""Rules: measurements against plain Python, bits against conditions, ablations against dropping a rule."""

import random
import re

from inkveil.llm.rule_ledger import BITS, POLICIES, ablation, ledger, verdicts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}),
        "n_word_lines": len(lines), "n_capitals": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z]", text)),
        "n_lettered_words": sum(bool(re.search(r"[A-Za-z\x80-\U0010ffff]", w)) for w in words),
        "n_adjacent": sum(a == b for a, b in zip(words, words[1:])),
    }


def texts():
    rng = random.Random(2)
    parts = ["the", "Stone", "ÜBER", "x#", "|", "12", "a\tb", "\n", "\n\n", "q\x0bw", "é", "same line here\n", " ", "THE"]
    found = [" ".join(rng.choices(parts, k=rng.randint(0, 90))) for _ in range(60)]
    return [*found, None, "", " ", "\n", "a a a a a", "ab cd " * 20000, "one two three\none two three\n", "x" * 5000]


def test_measures_and_verdicts(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(rows)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in verdicts(docs).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        expected, r = brute(text), got[i]
        assert {k: r[k] for k in expected} == expected, (i, text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.failures == 0)
        assert bool(r.failures & BITS["symbols"]) == (10 * r.n_symbols > r.n_words)


def test_ablation_is_what_dropping_a_rule_changes(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    rows = ledger(docs)
    failures = [r.failures for r in rows.collect()]
    for policy, rules in POLICIES.items():
        whole = sum(BITS[r] for r in rules)
        kept = sum(not f & whole for f in failures)
        for r in ablation(rows, policy).collect():
            assert (r.n_documents, r.n_kept) == (len(failures), kept)
            assert r.n_failed == sum(bool(f & BITS[r.rule]) for f in failures)
            assert r.n_alone == sum(not f & (whole - BITS[r.rule]) for f in failures) - kept


def test_empty_tables_null_ids_and_repeats(spark):
    schema = "doc_id long, text string"
    assert verdicts(spark.createDataFrame([], schema)).collect() == []
    got = verdicts(spark.createDataFrame([(None, "a b"), (1, "a"), (1, "a")], schema)).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got) == [(0, 2), (1, 1), (1, 1)]
