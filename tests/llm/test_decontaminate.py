"""Wu-Manber search against a plain search for every window."""

import hashlib
import random
import re

from inkveil.llm.decontaminate import SearchParams, hits, uncontaminated

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        theirs = words(other)
        m = min(10, len(theirs))
        for k in range(len(theirs) - m + 1 if theirs else 0):
            for i in range(len(own) - m + 1):
                if own[i:i + m] == theirs[k:k + m]:
                    hit.update(range(i, i + m))
                    found.add(item)
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def tables():
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choices(["The", "of", "río", "stone", "a1", "and"], k=n))
    items = [(i, text(rng.randint(8, 40))) for i in range(30)]
    items += [(100, items[3][1]), (101, "Only-four words, HERE"), (102, "x"), (103, ""), (104, None), (105, "of the " * 6)]
    docs = [text(rng.randint(0, 120)) for _ in range(40)]
    docs += [f"{text(5)} {item or ''} {text(6)}" for _, item in items[:12]]
    docs += ["only four\nwords here!", "an X.", None, "", "...", items[4][1].replace(" ", " -- ") * 3, "OF the " * 700 + items[5][1]]
    docs += [" ".join(items[6][1].split()[:9]), " ".join(items[7][1].split()[:10])]
    return docs, items


def test_hits_are_those_of_a_plain_search(spark):
    docs, items = tables()
    left = spark.createDataFrame([(i, t, i) for i, t in enumerate(docs)], "doc_id long, text string, item_id long")
    right = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")
    for params in (SearchParams(), SearchParams(block_patterns=7, stretch=16, table_bits=6)):
        got = {r.doc_id: r for r in hits(left, right, params).collect()}
        assert len(got) == len(docs)
        for i, text in enumerate(docs):
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == brute(text, items), (i, text)
            assert r.contaminated == (r.n_hit > 0)
        kept = uncontaminated(left, right, params)
        assert kept.columns == left.columns
        assert sorted(r.doc_id for r in kept.collect()) == [i for i in sorted(got) if not got[i].contaminated]


def test_one_block_is_open_at_a_time(spark, monkeypatch):
    """Many small blocks: each is gone from driver and tasks before the next but one is sent."""
    docs, items = tables()
    left = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    context, open_, most, sent = type(spark.sparkContext), set(), 0, 0
    broadcast = context.broadcast

    def watched(self, value):
        nonlocal most, sent
        found = broadcast(self, value)
        open_.add(found)
        most, sent = max(most, len(open_)), sent + 1
        destroy = found.destroy
        found.destroy = lambda: (open_.discard(found), destroy())
        return found

    monkeypatch.setattr(context, "broadcast", watched)
    got = {r.doc_id: r.n_hit for r in hits(left, right, SearchParams(block_patterns=60)).collect()}
    assert sent > 5 and most == 1 and got == {i: brute(t, items)[1] for i, t in enumerate(docs)}


def test_a_text_longer_than_a_chunk(spark):
    rng = random.Random(8)
    long = " ".join(f"{rng.randrange(16 ** 6):06x}" for _ in range(300_000))
    item = " ".join(long.split()[150_000:150_012])
    left = spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")
    right = spark.createDataFrame([(1, item), (2, "other words")], "item_id long, text string")
    for params in (SearchParams(), SearchParams(block_patterns=1)):
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in hits(left, right, params).collect()) == [
            (1, 300_000, 12, 1), (2, 1, 0, 0)]


def test_empty_tables_null_ids_and_repeats(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    left = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], docs)
    assert [r.n_hit for r in hits(left, spark.createDataFrame([], items)).collect()] == [0, 0, 0]
    right = spark.createDataFrame([(None, "b"), (2, "C"), (2, "c")], items)
    got = hits(left, right).collect()
    assert [(r.n_hit, r.n_items) for r in got] == [(2, 2)] * 3
    assert hits(spark.createDataFrame([], docs), right).collect() == []
