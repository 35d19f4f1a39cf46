"""The pipeline's stages on a small corpus, each against a brute-force version of it on the stage's own input."""

import random
import re

import pytest
from test_dart_minhash import similarity
from test_decontaminate import brute as leaks
from test_packing import check
from test_toxicity import INSULTS

import corpus_pipeline
from inkveil.llm.toxicity import scores

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def folded(text):
    """The words' bytes, a space behind each, and the span of each word in the text and in those bytes."""
    found, data = [], b""
    for m in WORD.finditer(text.translate(LOWER)):
        word = m.group().encode() + b" "
        found.append((m.span(), (len(data), len(data) + len(word) - 1)))
        data += word
    return data, found


def without_earlier_passages(rows, size=101, min_words=51):
    """Texts in order of their ids, without passages of so many words that an earlier row's text has."""
    seen, kept = set(), []
    for _, text, *_ in rows:
        data, words = folded(text or "")
        windows = [data[i:i + size] for i in range(len(data) - size + 1)]
        goes, cut, at = [w in seen for w in windows], [], 0
        seen.update(windows)
        while at < len(goes):
            end = at
            while end < len(goes) and goes[end]:
                end += 1
            if end > at:
                whole = [own for own, (s, e) in words if s >= at and e <= end - 1 + size]
                if whole:
                    s, e = whole[0][0], whole[-1][1]
                    if sum(m.start() < e and m.end() > s for m in re.finditer(r"[^ \t-\r]+", text)) >= min_words:
                        cut.append((s, e))
            at = end + 1
        for s, e in reversed(cut):
            text = text[:s] + text[e:]
        kept.append(text)
    return kept


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("mo", "ra", "ti", "les", "ken", "ob", "zu") for b in ("ra", "lin", "to", "sé", "pü", "x", "né")]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, prose(rng.randint(12, 40))) for i in range(8)]
    passage = prose(90)
    texts, labels = [], []
    for i in range(160):
        text = prose(rng.randint(30, 200))
        if i % 5 == 0:
            text += f" you {rng.choice(INSULTS)} {prose(3)} {rng.choice(INSULTS)}"
        elif i % 16 == 1:
            text = f"{text} {passage if i % 3 else passage.upper().replace(' ', ', ')} {prose(20)}"
        elif i % 16 == 2:
            text = f"{text} {items[i % 8][1]} {prose(5)}"
        texts.append(text)
        labels.append((i, 1, int(i % 5 == 0)))
    for base in (3, 4, 6, 7):
        words = texts[base].split()
        words[len(words) // 2] = "changed"
        texts += [texts[base], " ".join(words) if len(words) > 60 else texts[base]]
    texts += ["", None, "short one", prose(3000)]
    twice, shared, by_three = prose(70), prose(60), prose(55)
    texts += [f"{prose(40)} {twice} {prose(9)} {twice} {prose(30)}", f"{prose(50)} {shared} {prose(9)} {shared.title()} {prose(50)}",
              f"{prose(70)}\n{shared} {prose(20)}\n{shared}, {prose(30)}"]
    texts += [f"{prose(60 + i)} {by_three} {prose(30)}" for i in range(3)]
    root = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), 4) for i, t in enumerate(texts)]
    rows.append((None, "an id that is null", None, None, None, None))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, items


def test_each_stage_does_what_brute_force_does(spark, tables, tmp_path):
    root, items = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    states = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        states.append((name, [tuple(r) for r in before.collect()], [tuple(r) for r in docs.collect()]))
        assert n == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    ids = lambda rows: sorted((r[0] is not None, r[0] or 0) for r in rows)

    _, before, after = states[0]
    table = spark.read.parquet(f"{root}/documents.parquet")
    toxic = {r.doc_id for r in scores(table, spark.read.parquet(f"{root}/labels.parquet")).collect() if r.predicted}
    assert sorted(map(str, after)) == sorted(str(r) for r in before if r[0] not in toxic)
    assert len(toxic & {i for i in range(160) if i % 5 == 0}) >= 30 and not toxic & {i for i in range(160) if i % 5}

    _, before, after = states[1]
    kept = []
    for row in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0)):
        if not any(similarity(row[1], other[1]) >= 0.8 for other in kept):
            kept.append(row)
    assert sorted(map(str, after)) == sorted(map(str, kept)) and len(after) < len(before)

    _, before, after = states[2]
    assert ids(before) == ids(after)
    order = sorted(before, key=lambda r: (r[0] is not None, r[0] or 0))
    found, cut = {r[0]: r for r in after}, 0
    for row, text in zip(order, without_earlier_passages(order), strict=True):
        assert found[row[0]][1] == text and found[row[0]][2:4] == row[2:4]
        assert found[row[0]][4] == (len(text) if text != row[1] else row[4])
        cut += text != row[1]
    assert cut >= 8

    _, before, after = states[3]
    assert sorted(map(str, after)) == sorted(str(r) for r in before if leaks(r[1], items)[1] == 0) and len(after) < len(before)

    _, before, _ = states[4]
    check(docs.collect(), {r[0]: r[1] for r in before}, 1024)


def test_run_is_all_stages(spark, tables):
    root, _ = tables
    got = corpus_pipeline.run(spark, root)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 50
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_passages_of_over_50_words_go_and_shorter_ones_stay(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"{rng.randrange(16 ** 5):05x}" for _ in range(n))
    letters = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=51))
    short, just, below, one, two = prose(51)[:51 * 6], " ".join(w[:3] for w in prose(51).split()), prose(50), prose(30), prose(30)
    texts = [f"{prose(40)} {p} {prose(40)}" for p in (letters, short, just, below, one, two)]
    firsts = len(texts)
    # After the first ones: the same passages once more, and two shorter ones side by side.
    again = [(f"{prose(20)} A ", p, f" B {prose(20)}") for p in (letters, short, just, below, f"{one} {two}")]
    texts += ["".join(parts) for parts in again]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.passages(spark, docs, "").collect()}
    assert [got[i] for i in range(firsts)] == texts[:firsts]
    for n, (before, _, after) in enumerate(again[:3]):
        assert got[firsts + n] == before + after
    assert [got[firsts + 3], got[firsts + 4]] == texts[firsts + 3:]


def test_case_marks_and_lines_hide_no_passage_and_a_text_may_repeat_itself(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"{rng.randrange(16 ** 5):05x}" for _ in range(n))
    passage, own, long = prose(60), prose(60), prose(60_000)
    texts = [
        f"{prose(20)} {passage} {prose(20)}",
        f"{prose(20)} ### {passage.upper().replace(' ', ',' + chr(10))}! %%% {prose(20)}",
        f"{own} {prose(5)} {own}",                                 # repeats itself only
        f"X {passage} Y {passage.title()} Z",                      # both go: an earlier text has them
        f"{long} end", f"start {long}",                            # longer than a chunk
        f"{own} once more",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = [r.text for r in corpus_pipeline.passages(spark, docs, "").orderBy("doc_id").collect()]
    assert got == without_earlier_passages(list(enumerate(texts)))
    assert [got[0], got[2], got[4]] == [texts[0], texts[2], texts[4]]
    assert got[3] == "X  Y  Z" and got[5] == "start " and got[6] == " once more" and "! %%%" in got[1] and len(got[1]) < 300


def test_a_passage_is_in_one_earlier_text(spark):
    rng = random.Random(7)
    prose = lambda n: [f"{rng.randrange(16 ** 5):05x}" for _ in range(n)]
    chain, tail, marks = prose(64), prose(60), prose(40)
    dashed = " - ".join(marks[:30])
    texts = [
        " ".join(prose(9) + chain[:40] + prose(9)),
        " ".join(prose(9) + chain[22:] + prose(9)),   # the two overlap by more than a window, none has 51 words of the next
        " ".join(["X"] + chain + ["Y"]),
        "la " * 47 + "end",
        "A " + "la " * 233 + "B",                     # 47 words at most are in another text
        "C " + "la " * 51 + "D",                      # all 51 are
        " ".join(prose(9) + chain[:40] + tail),       # the next one's passage is 80 words of this one
        " ".join(["E"] + chain + tail[:3]),           # 64 words are in the third text
        " ".join(["F"] + chain[20:40] + tail + ["G"]),
        " ".join(prose(5)) + f" {dashed} " + " ".join(prose(5)),
        f"H {dashed} I",                              # 59 between white space in both
        f"J {' '.join(marks[:30])} K",                # 30 words
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = [r.text for r in corpus_pipeline.passages(spark, docs, "").orderBy("doc_id").collect()]
    assert [got[n] for n in (0, 1, 2, 3, 4, 6, 9, 11)] == [texts[n] for n in (0, 1, 2, 3, 4, 6, 9, 11)]
    assert (got[5], got[7], got[8], got[10]) == ("C  D", f"E  {' '.join(tail[:3])}", "F  G", "H  I")


def test_marks_that_stand_alone_at_the_ends_of_a_passage_are_words_of_it(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"{rng.randrange(16 ** 5):05x}" for _ in range(n))
    cells, fewer = prose(25).replace(" ", " | "), prose(24).replace(" ", " | ")  # 49 and 47 words between white space
    texts = [
        f"{prose(9)} | {cells} | {prose(9)}",
        f"A | {cells} | B",                           # 51 in both
        f"{cells} C",                                 # 49 here
        f"D - {cells} *",                             # 51, and marks are not compared
        f"{prose(9)}, | {fewer} | {prose(9)}",
        f"E | {fewer} | F",                          # 49 in both
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = [r.text for r in corpus_pipeline.passages(spark, docs, "").orderBy("doc_id").collect()]
    assert [got[n] for n in (0, 2, 4, 5)] == [texts[n] for n in (0, 2, 4, 5)]
    assert (got[1], got[3]) == ("A |  | B", "D -  *")
