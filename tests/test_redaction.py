import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtures import a4_pages, fold_lines, line, page_of, words_df
from inkveil.operators import apply, detect, lines, pages, regions
from inkveil.params import RuleParams, RuleSet
from inkveil.plans.pipeline import Redactor
from inkveil.sources import rules

NO_REGIONS = RuleSet(page1_regions=(), page2_regions=())


def removed_per_page(spark, pages_, rules_=NO_REGIONS, params=RuleParams(), page_rows=1000):
    """Texts of the words that go, one list per given page, in word order. All pages in one run."""
    rows = [(doc, *r[1:]) for doc, page in enumerate(pages_) for r in page]
    redactor = Redactor(rules_, params, page_rows)
    bounds = a4_pages(spark, *[(doc, 1) for doc in range(len(pages_))])
    kept = {(r.doc_id, r.word_idx) for r in redactor.kept(words_df(spark, rows), bounds).collect()}
    return [[r[7] for r in page if (doc, r[2]) not in kept] for doc, page in enumerate(pages_)]


def removed(spark, page, rules_=NO_REGIONS, params=RuleParams()):
    return removed_per_page(spark, [page], rules_, params)[0]


ONE_LINE = {
    "Nome: Ana Lima CPF: 1": "Ana Lima 1",
    "Nome: Ana Sexo: F": "Ana",                                   # a keep label ends the value
    "Nome Ana": "Ana",                                            # labels match without colon
    "x Nome:": "",                                                # nothing behind the label
    "Médico Responsável: X": "X",                                 # adjacent labels
    "Reg. Clínico: 99": "",                                       # labels with a blank match no word
    "Nome: A Intervalo PR: 160": "A Intervalo PR: 160",           # and do not end a value
    "NOME: Ana": "",                                              # case matters
    "x CRM 12 Data: y": "CRM 12 Data: y",                         # the register tail passes keep labels
    "crm: 12": "",                                                # not a register token
    "CRM: 1 x crm 2": "CRM: 1 x crm 2",
    "Nome: Ana Data 1 CPF: 2 3": "Ana 2 3",
}


@pytest.mark.parametrize("split", [False, True])
def test_one_line(spark, split):
    options = {"params": RuleParams(page_split_rows=1), "page_rows": None} if split else {}
    got = removed_per_page(spark, [page_of(text) for text in ONE_LINE], **options)
    assert dict(zip(ONE_LINE, map(" ".join, got))) == ONE_LINE


SEVERAL_WORDS = {
    "Nome: Ana Lima CPF: 1": "Ana Lima 1",
    "Reg. Clínico: 99": "99",                                     # now found
    "x Reg. Clínico 99 CPF: 1": "99 1",                           # the last word may lack its colon
    "Reg. Outro Clínico: 99": "",                                # not one after the other
    "Nome: A Intervalo PR: 160 b": "A",                           # ends the value, and its own is kept
    "Nome: A Data de Nascimento: 1 CPF: 2": "A 2",                # longer than the label Data
    "Médico Responsável: X": "X",
    "Data 1 Nome: Eixo P-QRS-T: 5": "",
    "Nome: Reg. Clínico:": "",                                    # no value behind either
    "Nome: Reg. x": "Reg. x",                                     # the beginning of a label only
}


@pytest.mark.parametrize("split", [False, True])
def test_labels_of_several_words(spark, split):
    """On request only: test_one_line holds that they match nothing otherwise."""
    params = RuleParams(multiword_labels=True, page_split_rows=1 if split else 2048)
    got = removed_per_page(spark, [page_of(text) for text in SEVERAL_WORDS], params=params, page_rows=None if split else 1000)
    assert dict(zip(SEVERAL_WORDS, map(" ".join, got))) == SEVERAL_WORDS


def test_labels_that_overlap_and_lines_that_end(spark):
    rules_ = RuleSet(redact_labels=("a b:", "b c:", "c d e:", "x:"), keep_labels=("e f:",), page1_regions=(), page2_regions=())
    page = page_of("a b c d e f g", "b", "c x y b c", "a b", "c z")
    redactor = Redactor(rules_, RuleParams(), 100)
    hits = detect.multiword_hits(redactor.tokens(words_df(spark, page)), rules.label_table(spark, rules_))
    got = sorted((r.line_no, r.pos, r.n_words, r.label) for r in hits.collect())
    # From the left: "b c" begins inside "a b"; then "c d e", in which "e f" begins. No label goes on in the next line.
    assert got == [(0, 0, 2, "a b:"), (0, 2, 3, "c d e:"), (2, 1, 1, "x:"), (2, 3, 2, "b c:"), (3, 0, 2, "a b:")]
    none = detect.multiword_hits(redactor.tokens(words_df(spark, page)), rules.label_table(spark, RuleSet((), ())))
    assert none.collect() == []


def test_spans(spark):
    redactor = Redactor(NO_REGIONS, RuleParams(), 100)
    spans = detect.value_spans(redactor.marked_tokens(words_df(spark, page_of("Nome: Ana Lima CPF: 1"))))
    assert sorted((r.start_pos, r.end_pos) for r in spans.collect()) == [(1, 3), (4, 5)]


def signature_page(above, gap, register="x CRM 12"):
    """A line whose padded lower edge is `gap` above the register line."""
    upper = line(above, 100.0)
    return upper + line(register, 100.0 + 9.0 + 1.0 + gap, first=len(upper))


def test_signature(spark):
    cases = [
        (signature_page("Dr Silva", 2.0), "Dr Silva CRM 12"),
        (signature_page("Dr: Silva", 2.0), "CRM 12"),               # a colon marks a labelled line
        (signature_page("Dr Silva", 11.0), "CRM 12"),               # too far above
        (signature_page("Dr Silva", 10.0), "Dr Silva CRM 12"),
        (signature_page("Dr Silva", 2.0, "x CRM/SP 12"), "Dr Silva"),  # a search hit is no register token
        (line("Dr Silva", 100.0, x=200.0) + line("CRM 12", 112.0, first=2), "CRM 12"),  # not above the hit
        (line("Dr Silva", 100.0, x=60.0) + line("CRM 12", 112.0, first=2), "Dr Silva CRM 12"),
    ]
    # The same at every height, so that lines and hits also meet across the strips of a page.
    moved = [([(*r[:4], r[4] + dy, r[5], r[6] + dy, r[7]) for r in page], gone)
             for page, gone in cases for dy in range(0, 300, 7)]
    got = removed_per_page(spark, [page for page, _ in moved])
    assert [" ".join(g) for g in got] == [gone for _, gone in moved]


def test_signature_has_no_second_choice(spark):
    page = line("Dr Silva", 86.0) + line("a: b", 100.0, first=2) + line("CRM 12", 112.0, first=4)
    assert removed(spark, page, params=RuleParams(prevline_tolerance=30.0)) == ["CRM", "12"]


def test_one_pass_equals_the_single_detectors(spark):
    rng = random.Random(3)
    vocabulary = ["Nome:", "CPF", "Data:", "CRM", "crm", "CRM/SP", "Ana", "Lima", "12", "a:"]
    rows = []
    for doc in range(6):
        for n in range(25):
            rows += line(" ".join(rng.choices(vocabulary, k=rng.randint(1, 9))), 40.0 + n * 13.0,
                         x=rng.randint(0, 200) * 1.0, doc=doc, first=1000 * n)
    redactor = Redactor(NO_REGIONS, RuleParams(), 10_000)
    tokens = redactor.marked_tokens(words_df(spark, rows))
    together = {tuple(r) for r in detect.text_redactions(tokens, redactor.params).distinct().collect()}
    box = ["rx0", "ry0", "rx1", "ry1"]
    single = {
        tuple(r) for rule, df in (
            ("value", detect.value_boxes(tokens, redactor.params)),
            ("register_tail", detect.register_tail_boxes(tokens, redactor.params)),
            ("signature", detect.signature_lines(tokens, redactor.params)))
        for r in df.select("doc_id", "page_no", F.lit(rule).alias("rule"), *box).distinct().collect()}
    assert together == single and len(together) > 100
    assert {t[2] for t in together} == {"value", "register_tail", "signature"}


def test_marks_agree_with_plain_python(spark):
    texts = ["CRM", " CRM ", "crm:", "Nome", "Sexo:", "x:y", "CRM/SP"]
    rows = [(1, 1, i, 0.0, 0.0, 1.0, 1.0, t) for i, t in enumerate(texts)]
    r = RuleSet()
    got = detect.mark_words(words_df(spark, rows), rules.label_table(spark, r), rules.token_table(spark, r),
                            r.search_terms)
    marks = {x.text: (x.action, x.is_register, x.is_hit, x.has_colon) for x in got.collect()}
    assert marks == {
        "CRM": ("redact", True, True, False), " CRM ": (None, True, True, False), "crm:": (None, False, True, True),
        "Nome": ("redact", False, False, False), "Sexo:": ("keep", False, False, True),
        "x:y": (None, False, False, True), "CRM/SP": (None, False, True, False)}


def box_of(spark, region, page=1):
    rules_ = RuleSet(page1_regions=(region,), page2_regions=())
    row = regions.fixed_boxes(a4_pages(spark, (1, page)), rules.region_table(spark, rules_)).collect()[0]
    return row.rx0, row.ry0, row.rx1, row.ry1


def test_regions(spark):
    assert box_of(spark, (50, 50, 200, 80)) == (595.0, 842.0, 595.0, 842.0)
    assert box_of(spark, (0.5, 0.5, 0.25, 0.25)) == box_of(spark, (0.25, 0.25, 0.5, 0.5))
    nothing = RuleSet(redact_labels=(), keep_labels=(), register_tokens=(), page1_regions=((50, 50, 200, 80),))
    assert removed(spark, page_of("a b c"), nothing) == []
    corner = RuleSet(redact_labels=(), keep_labels=(), register_tokens=(), page1_regions=((0, 0, 0.03, 1),))
    assert removed(spark, page_of("a b c"), corner) == ["a"]
    bad = rules.region_table(spark, RuleSet(page2_regions=((0.5, 0, 0.25, 1), (0, 0, 1, 1))))
    rasters = spark.createDataFrame([(7, 2, 100, 100), (8, 1, 100, 100)], "doc_id LONG, page_no INT, img_w INT, img_h INT")
    assert [tuple(r) for r in rules.page_errors(rasters, bad).collect()] == [(7, rules.OUT_OF_ORDER)]
    good = rules.region_table(spark, RuleSet(page2_regions=((0, 0, 1, 1),)))
    assert rules.page_errors(rasters, good).collect() == []


def test_overlap_join_equals_all_pairs(spark):
    rng = random.Random(11)
    words, boxes = [], []
    for i in range(700):
        x, y = rng.uniform(-50, 3000), rng.uniform(-50, 1500)
        w, h = rng.choice([(20, 9), (127.5, 15.5), (128.5, 9), (20, 40), (900, 200), (5000, 3000), (128, 16)])
        words.append((rng.randint(1, 2), 1, i, x, y, x + w, y + h, "w"))
    for i in range(25):
        x, y = rng.uniform(-100, 2500), rng.uniform(-100, 1500)
        boxes.append((rng.randint(1, 2), 1, "r", x, y, x + rng.uniform(0, 300), y + rng.choice([0.0, 12.0, 400.0])))
    schema = "doc_id BIGINT, page_no INT, rule STRING, rx0 DOUBLE, ry0 DOUBLE, rx1 DOUBLE, ry1 DOUBLE"
    w, b = words_df(spark, words), spark.createDataFrame(boxes, schema)
    hit = {x[2] for x in words for r in boxes if x[0] == r[0] and r[5] > r[3] and r[6] > r[4]
           and x[3] < r[5] and x[5] > r[3] and x[4] < r[6] and x[6] > r[4]}
    gone = [r.word_idx for r in apply.removed_words(w, b).collect()]
    kept = [r.word_idx for r in apply.kept_words(w, b).collect()]
    assert sorted(gone) == sorted(hit) and sorted(kept) == sorted(set(range(700)) - hit)
    assert 50 < len(hit) < 650


def test_page_policy_and_publication(spark):
    rows = [r for p in (1, 2, 3, 4) for r in page_of("Nome: Ana", f"p{p}", page=p)]
    words, bounds = words_df(spark, rows), a4_pages(spark, *[(1, p) for p in (1, 2, 3, 4)])
    outcome = {r.page_no: r.outcome for r in pages.page_policy(bounds).collect()}
    assert outcome == {1: "text", 2: "raster", 3: "dropped", 4: "dropped"}
    out = Redactor(NO_REGIONS, RuleParams(dpi=72), 100).publish(words, bounds).collect()
    assert {(r.page_no, r.line_no, r.kind, r.text, r.img_w, r.img_h) for r in out} == {
        (1, 0, "text", "Nome:", None, None), (1, 1, "text", "p1", None, None), (2, None, "raster", None, 595, 842)}


def test_routing(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id BIGINT")
    got = pages.page_routing(docs, a4_pages(spark, (1, 1), (2, 1), (2, 2), (2, 3))).collect()
    assert {(r.doc_id, r.n_pages, r.route, r.error) for r in got} == {
        (1, 1, "single", None), (2, 3, "multi", None), (3, 0, "error", "PDF must have at least 1 page")}


def test_nothing_that_was_removed_is_published(spark):
    rows = [r for d in range(5) for r in page_of("Nome: Ana Lima", "Dr Silva", "CRM 12 x", doc=d, pitch=12.0)]
    words, bounds = words_df(spark, rows), a4_pages(spark, *[(d, 1) for d in range(5)])
    redactor = Redactor(NO_REGIONS, RuleParams(), 100)
    boxes = redactor.plan(words, bounds)
    gone = apply.removed_words(words, boxes).select("doc_id", "page_no", "word_idx")
    kept = redactor.kept(words, bounds).select("doc_id", "page_no", "word_idx")
    assert gone.intersect(kept).count() == 0
    assert gone.count() + kept.count() == len(rows)
    assert fold_lines(rows, 1.0)


def test_labels_in_both_lists_are_kept(spark):
    r = RuleSet(redact_labels=("A:", "B:"), keep_labels=("B:",))
    merged = {x.label: x.action for x in rules.merge_labels(rules.label_lists(spark, r)).collect()}
    assert merged == {"A:": "redact", "B:": "keep"}
    assert merged == {x.label: x.action for x in rules.label_table(spark, r).collect()}


def test_dense_cells_are_dealt_out(spark):
    """200,000 large words and 5,000 boxes on a page: equal to all pairs, and no task has a quarter of the words."""
    n, m = 200_000, 5000
    rng = np.random.default_rng(3)
    x, y = rng.uniform(0, 60_000, n), rng.uniform(0, 60_000, n)
    wide, high = rng.uniform(1100, 1300, n), rng.uniform(5, 60, n)
    bx, by = rng.uniform(0, 60_000, m), rng.uniform(0, 60_000, m)
    words = spark.createDataFrame(pd.DataFrame({
        "doc_id": 1, "page_no": 1, "word_idx": np.arange(n), "x0": x, "y0": y, "x1": x + wide, "y1": y + high}))
    boxes = spark.createDataFrame(pd.DataFrame({
        "doc_id": 1, "page_no": 1, "rule": "r", "rx0": bx, "ry0": by, "rx1": bx + 40, "ry1": by + 30}))
    touched = np.zeros(n, bool)
    for a, b in zip(bx, by):
        touched |= (x < a + 40) & (x + wide > a) & (y < b + 30) & (y + high > b)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = apply.removed_words(words, boxes, 20_000).select("word_idx", F.spark_partition_id().alias("task")).collect()
        kept = apply.kept_words(words, boxes, 20_000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.word_idx for r in found) == np.flatnonzero(touched).tolist() and 1000 < touched.sum() < n - 1000
    assert sum(r["count"] for r in kept) == n - touched.sum() and max(r["count"] for r in kept) < n / 4


def test_dense_and_other_cells_and_pages_without_a_name(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, None]), 1, i, x := rng.uniform(0, 900), y := rng.uniform(0, 900), x + rng.choice([5, 300, 3000]), y + 9.0)
            for i in range(600)]
    words = spark.createDataFrame(rows, "doc_id long, page_no int, word_idx long, x0 double, y0 double, x1 double, y1 double")
    boxes = spark.createDataFrame(
        [(rng.choice([1, 2, None]), 1, "r", x := rng.uniform(0, 900), y := rng.uniform(0, 900), x + 20, y + 20) for _ in range(25)],
        "doc_id long, page_no int, rule string, rx0 double, ry0 double, rx1 double, ry1 double")
    plain = sorted(r.word_idx for r in apply.removed_words(words, boxes).collect())
    assert 20 < len(plain) < 580
    for dense in (3, 40, 1000):
        assert sorted(r.word_idx for r in apply.removed_words(words, boxes, dense).collect()) == plain
        kept = sorted(r.word_idx for r in apply.kept_words(words, boxes, dense).collect())
        assert kept == sorted(set(range(600)) - set(plain))
