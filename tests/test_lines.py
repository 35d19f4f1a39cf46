import random
import time

import pytest
from pyspark.sql import functions as F

from fixtures import fold_lines, page_of, words_df
from inkveil.operators import lines
from inkveil.params import RuleParams


def placed(tokens):
    return {(r.doc_id, r.page_no, r.word_idx): (r.line_no, r.pos) for r in tokens.collect()}


def column_of(ys, xs=None):
    return [(1, 1, i, (xs or [10.0 * j for j in range(len(ys))])[i], y, 15.0, y + 9, "w") for i, y in enumerate(ys)]


def test_running_mean(spark):
    cases = {
        (0.0, 1.0, 1.5, 1.75): [0, 0, 0, 0],   # means 0.5, 1.0: all join
        (0.0, 1.0, 1.75): [0, 0, 1],           # mean 0.5: 1.25 away, although 0.75 from the last word
    }
    rows = [(doc, *r[1:]) for doc, ys in enumerate(cases) for r in column_of(ys)]
    for params, page_rows in ((RuleParams(), 10), (RuleParams(page_split_rows=2), None)):
        got = placed(lines.line_tokens(words_df(spark, rows), params, page_rows))
        assert [[got[(doc, 1, i)][0] for i in range(len(ys))] for doc, ys in enumerate(cases)] == list(cases.values())


def test_words_follow_bands_within_a_line(spark):
    rows = column_of([10.125, 10.375], xs=[50.0, 10.0])
    got = placed(lines.line_tokens(words_df(spark, rows), RuleParams(), 10))
    assert got == {(1, 1, 0): (0, 0), (1, 1, 1): (0, 1)}


@pytest.mark.parametrize("tolerance", [0.0625, 0.15, 1.0, 5.0])
def test_both_plans_equal_the_plain_fold(spark, tolerance):
    rng = random.Random(7)
    rows = []
    for doc in range(12):
        spread = rng.choice([4, 20, 200])
        for i in range(rng.randint(1, 120)):
            y = rng.randint(0, spread * 16) / 16
            x = rng.randint(0, 40) * 12.0
            rows.append((doc, rng.randint(1, 2), i, x, y, x + 10, y + 9, rng.choice(["a", "b:", " "])))
    words = lines.non_blank(words_df(spark, rows)).repartition(3)
    expected = fold_lines(rows, tolerance)
    whole = lines.line_tokens(words, RuleParams(line_tolerance=tolerance), 120)
    split = lines.line_tokens(words, RuleParams(line_tolerance=tolerance, page_split_rows=30))
    assert placed(whole) == expected
    assert placed(split) == expected


def test_long_runs_of_one_baseline(spark):
    # 3,000 words pull the mean all the way; the next word is then a tolerance off the run, not off the start.
    rows = column_of([0.0] + [1.0] * 3000 + [2.0, 3.25], xs=[float(i) for i in range(3003)])
    split = lines.line_tokens(words_df(spark, rows), RuleParams(page_split_rows=100))
    assert placed(split) == fold_lines(rows, 1.0)


def test_line_text_boxes_and_length(spark):
    tokens = lines.line_tokens(words_df(spark, page_of("Nome: Ana", "x")), RuleParams(), 10)
    text = {r.line_no: r.line_text for r in lines.line_text(tokens).collect()}
    assert text == {0: "Nome: Ana", 1: "x"}
    boxes = {r.line_no: (r.rx0, r.ry0, r.rx1, r.ry1) for r in lines.line_boxes(tokens, RuleParams()).collect()}
    assert boxes[0] == (9.0, 99.0, 56.0, 110.0)
    assert {(r.line_no, r.line_len) for r in lines.with_line_length(tokens).collect()} == {(0, 2), (1, 1)}


def test_blank_words_are_dropped(spark):
    rows = [(1, 1, i, 0.0, 0.0, 1.0, 1.0, t) for i, t in enumerate(["a", " ", " ", "", " b"])]
    assert [r.word_idx for r in lines.non_blank(words_df(spark, rows)).collect()] == [0, 4]


def dense_page(spark, n, y):
    """n words on one page, 400 to a row of the grid."""
    return spark.range(n).selectExpr(
        "1L as doc_id", "1 as page_no", "id as word_idx", "(id % 400) * 1.5D as x0", f"{y} as y0",
        "(id % 400) * 1.5D + 1 as x1", f"{y} + 1 as y1", "'w' as text")


@pytest.mark.parametrize("threshold", ["-1", "256k"])  # words are above either, rows per cell below the second
def test_a_large_page_spreads_over_tasks(spark, threshold):
    n = 60_000
    settings = {"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        words = dense_page(spark, n, "(id div 400) * 4.0D")
        tokens = lines.line_tokens(words, RuleParams(page_split_rows=1000)).cache()
        sizes = [r["count"] for r in tokens.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 4
        wrong = tokens.where("line_no <> word_idx div 400 or pos <> word_idx % 400")
        assert wrong.isEmpty()
        tokens.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_large_pages_are_a_short_list_of_their_real_size(spark):
    """The list has a row or two a page, and is broadcast by what its rows take, not by what encodings make of them."""
    n, pages = 110, 2000
    words = spark.range(n * pages).selectExpr(
        f"id div {n} as doc_id", "1 as page_no", f"id % {n} + 100 * (id div {n}) as word_idx", "0D as x0", "0D as y0")
    large = lines._large_pages(words, 100)
    listed = large.groupBy("_page.doc_id").count().collect()
    assert len(listed) == pages and max(r["count"] for r in listed) <= 2
    flagged = lines._with_size(words, large)
    assert flagged.where("_large").count() == n * pages
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, broadcast in (("36k", False), ("1m", True)):  # 20 bytes a row, and more in memory
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            found = lines._with_size(words, large)._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in found) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_pages_are_found_by_any_word_numbers(spark):
    rng, rows = random.Random(5), []
    for doc, step in enumerate((1, -1, 1000, 65_536, 10**12)):
        rows += [(doc, 1, i * step, 0.0, rng.randint(0, 160) / 16, 1.0, 20.0, "w") for i in range(90)]
    rows += [(9, 1, i, 0.0, 1.0, 1.0, 20.0, "w") for i in range(20)]
    words = words_df(spark, rows + [(None, 1, None, 0.0, 5.0, 1.0, 20.0, "w")] * 60)
    flagged = {(r.doc_id, r._large): r["count"] for r in lines._with_size(words, lines._large_pages(words, 50))
               .groupBy("doc_id", "_large").count().collect()}
    assert flagged == {**{(doc, True): 90 for doc in range(5)}, (9, False): 20, (None, True): 60}
    split = lines.line_tokens(words.where("doc_id is not null"), RuleParams(page_split_rows=50, block_words=16))
    assert placed(split) == fold_lines(rows, 1.0)


CHAINED = "(id div 10) * 0.25D + (id % 10) * 0.02D"  # no gap settles a line: the baseline follows the slope
PHASES = "id * 0.6D"  # lines of three words: three phases that never meet
LATE = "IF(id < 1500, 0.0D, 1.0D) + IF(id = 2500, 0.75D, 0.0D)"  # a baseline that moves once, long after its line began


@pytest.mark.parametrize("y, block_words", [(CHAINED, 64), (CHAINED, 1024), (PHASES, 7), (PHASES, 64), (LATE, 100)])
def test_blocks_equal_the_plain_fold(spark, y, block_words):
    rows = [tuple(r) for r in dense_page(spark, 3000, y).collect()]
    split = lines.line_tokens(dense_page(spark, 3000, y), RuleParams(page_split_rows=100, block_words=block_words))
    assert placed(split) == fold_lines(rows, 1.0)


def test_lines_that_never_meet_pass_block_after_block(spark):
    """Two words on a baseline and half a tolerance above it by turns: what enters a block passes all of it."""
    rows = column_of([0.0] + [1.0 + 0.5 * (i % 2) * (i % 7 == 0) for i in range(400)], xs=[float(i) for i in range(401)])
    split = lines.line_tokens(words_df(spark, rows), RuleParams(page_split_rows=100, block_words=16))
    assert placed(split) == fold_lines(rows, 1.0)


def test_a_chained_page_grows_linearly_and_spreads(spark):
    """A page that is one line: no task takes a tenth of it, and twice the words take about twice the time."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64",
                "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)

    def seconds(n):
        start = time.monotonic()
        tokens = lines.line_tokens(dense_page(spark, n, CHAINED), RuleParams(page_split_rows=1000))
        found = tokens.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("pos").alias("last")).collect()
        assert sum(r.n for r in found) == n and max(r["last"] for r in found) == n - 1
        assert n < 200_000 or max(r.n for r in found) < n / 10
        return time.monotonic() - start

    try:
        seconds(20_000)  # compiles
        small = min(seconds(250_000), seconds(250_000))
        assert seconds(500_000) < 2.5 * small
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
