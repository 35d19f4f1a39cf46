"""Words -> visual lines.

A line is found by a fold over the words of a page in reading order: a word joins the line when its
y0 is within the tolerance of the line's running baseline, and the baseline then moves half way to it.

Two exact plans compute it:

* pages of bounded size: one shuffle on (doc_id, page_no), one sort, and windows over that sort, with the fold over an
  array of the page's y0. That array is on every row of the page for one step, which is why the bound is low.
* pages above RuleParams.page_split_rows: words are dealt out by ranges of the whole reading order and numbered
  there, and a page is cut into blocks of `block_words`. Where a fold stands at the end of a block depends on all
  words before it, but few baselines are possible: lines that live on meet, as every word halves their distance. So
  every block finds the baselines it may leave with (those of lines begun in it, and of lines that pass through), and
  where each baseline that may enter it leads; a page follows these small tables block by block, which gives each block
  the one baseline that really enters it, and all blocks fold their words at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkveil.functions.geometry import tenths
from inkveil.functions.text import is_blank
from inkveil.params import RuleParams
from inkveil.session import staged, union_all

PAGE = ["doc_id", "page_no"]
LINE = [*PAGE, "line_no"]

# Parts that the words of a large page are dealt to while it is told from small ones; so many words that follow each
# other are in one part.
PARTS, PART_WORDS = 64, 1024


def non_blank(words: DataFrame) -> DataFrame:
    return words.filter(~is_blank(F.col("text")))


def reading_order(words: DataFrame) -> DataFrame:
    """Adds band (y0 rounded half-even to tenths) and ord, the 1-based position on the page."""
    by_page = Window.partitionBy(*PAGE).orderBy("band", "x0", "word_idx")
    return _with_band(words).withColumn("ord", F.row_number().over(by_page))


def reading_order_split(words: DataFrame) -> DataFrame:
    """The same for pages of any size, which no task sees whole; ord is a bigint.

    Words are dealt out by ranges of the whole order and numbered where they are: Spark's row number has the task in its
    upper bits and the place there in the lower 33. A page's words in a task follow each other, so their places
    and the counts of the tasks before (a row per page and task) give the position. Writes the dealt words once.
    """
    order = [*PAGE, "band", "x0", "word_idx"]
    dealt = _with_band(words).repartitionByRange(*order).sortWithinPartitions(*order)
    part = F.struct(*PAGE, F.shiftright("_at", 33).alias("task")).alias("_part")
    placed = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "in-order").withColumn("_part", part)
    counted = placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[f"_part.{c}" for c in PAGE]).orderBy("_part.task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counted.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(begins, "_part").withColumn("ord", F.col("_before") + F.col("_at") - F.col("_first") + 1).drop(
        "_part", "_at", "_first", "_before")


def line_tokens(words: DataFrame, params: RuleParams, page_rows: int | None = None) -> DataFrame:
    """Adds line_no and pos (both 0-based) to every word; other columns pass through.

    page_rows is the proven largest number of words on a page, where the source has one. Without
    it, pages are counted first, and those that are too large take the split plan and are written as blocks. Other
    columns of large pages must have types that can be sorted.
    """
    if page_rows is not None and page_rows <= params.page_split_rows:
        return _tokens_by_page(words, params)
    large = _large_pages(words, params.page_split_rows)
    if large.isEmpty():
        return _tokens_by_page(words, params)
    sized = _with_size(words, large)
    columns = words.columns
    return union_all(_tokens_by_page(sized.where(~F.col("_large")).select(columns), params),
                     _tokens_by_block(sized.where("_large").select(columns), params))


def _with_size(words: DataFrame, large: DataFrame) -> DataFrame:
    """Adds _large: whether the word's page is listed. The join deals the words of a page to several parts."""
    keyed = words.withColumn("_page", F.struct(*PAGE, _part().alias("part")))
    return keyed.join(large.withColumn("_hit", F.lit(True)), "_page", "left").withColumn(
        "_large", F.coalesce("_hit", F.lit(False))).drop("_page", "_hit")


def _part() -> Column:
    return F.pmod(F.xxhash64(F.expr(f"word_idx div {PART_WORDS}")), F.lit(PARTS).cast("bigint"))


def _large_pages(words: DataFrame, split_rows: int) -> DataFrame:
    """A table with a row for each part of a large page that has words: one or two where pages are not much larger."""
    counted = words.select(*PAGE, _part().cast("int").alias("part")).groupBy(*PAGE).agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_or(shiftleft(1L, part))").alias("parts")).filter(F.col("n") > split_rows)
    part = F.explode(F.expr(f"filter(sequence(0L, {PARTS - 1}L), p -> getbit(parts, CAST(p AS INT)) = 1)")).alias("part")
    return staged(counted.select(*PAGE, part).select(F.struct(*PAGE, "part").alias("_page")), "large-pages", plain=True)


def with_line_length(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("line_len", F.count(F.lit(1)).over(Window.partitionBy(*LINE)))


def line_boxes(tokens: DataFrame, params: RuleParams) -> DataFrame:
    return tokens.groupBy(*LINE).agg(*padded_box(params))


def line_text(tokens: DataFrame, *more: Column) -> DataFrame:
    """The words of each line joined by one blank, and further aggregates per line."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return tokens.groupBy(*LINE).agg(
        F.array_join(F.transform(ordered, lambda w: w["text"]), " ").alias("line_text"), *more)


def padded_box(params: RuleParams) -> list[Column]:
    """Aggregates for the padded bounding box of a group of words."""
    return [
        (F.min("x0") - params.padding).alias("rx0"), (F.min("y0") - params.padding).alias("ry0"),
        (F.max("x1") + params.padding).alias("rx1"), (F.max("y1") + params.padding).alias("ry1"),
    ]


def _with_band(words: DataFrame) -> DataFrame:
    return words.withColumn("band", tenths(F.col("y0")))


def _tokens_by_page(words: DataFrame, params: RuleParams) -> DataFrame:
    columns = words.columns
    page = Window.partitionBy(*PAGE).orderBy("band", "x0", "word_idx")
    so_far = page.rowsBetween(Window.unboundedPreceding, 0)
    whole = page.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    # The first word of a page folds the y0 of the whole page; the others look up the result.
    folded = _with_band(words) \
        .withColumns({"ord": F.row_number().over(page), "ys": F.collect_list("y0").over(whole)}) \
        .withColumn("starts", F.when(F.col("ord") == 1, F.expr(_starts("ys", "CAST(NULL AS DOUBLE)", params.line_tolerance)))) \
        .drop("ys")
    marked = folded.withColumn("starts", F.first("starts", True).over(so_far)) \
        .withColumn("start", F.array_contains("starts", F.col("ord"))).drop("starts")
    numbered = marked.withColumns({
        "line_no": F.count_if("start").over(so_far).cast("int") - 1,
        "pos": F.col("ord") - F.max(F.when(F.col("start"), F.col("ord"))).over(so_far)})
    return numbered.select(*columns, "line_no", "pos")


def _collected(words: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per key, its words in ws, sorted."""
    word = F.struct(*columns).alias("word")
    return words.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*order, word))).alias("ws"))


def _starts(ys: str, mean: str, tol: float) -> str:
    """SQL for the 1-based positions in the array ys at which a line starts, where one with this baseline is open before."""
    return f"""
        aggregate({ys}, named_struct('mean', {mean}, 'ord', 0, 'starts', CAST(array() AS ARRAY<INT>)),
          (acc, y) -> IF(acc.mean IS NULL OR abs(y - acc.mean) > {tol}D,
            named_struct('mean', y, 'ord', acc.ord + 1, 'starts', concat(acc.starts, array(acc.ord + 1))),
            named_struct('mean', (acc.mean + y) / 2, 'ord', acc.ord + 1, 'starts', acc.starts)),
          acc -> acc.starts)"""


def _listed(groups: DataFrame, key: list[Column], base: str, open_: str) -> DataFrame:
    """The key and word, line_no and pos of each word of groups (ws, starts): `base` lines began before, and the last one
    has `open_` words there."""
    rows = f"""
        flatten(transform(firsts, (first, l) ->
          transform(slice(ws, first, coalesce(get(firsts, l + 1), size(ws) + 1) - first),
            (w, p) -> named_struct('word', w.word, 'line_no', CAST({base} + l - lead AS INT),
                                   'pos', CAST(IF(l < lead, {open_}, 0) + p AS INT)))))"""
    opens = "coalesce(get(starts, 0), 0) = 1"
    return groups.withColumns({
        "lead": F.expr(f"IF({opens}, 0, 1)"), "firsts": F.expr(f"IF({opens}, starts, concat(array(1), starts))"),
    }).select(*key, F.inline(F.expr(rows)))


def _block_key(doc_id: Column, page_no: Column, block: Column) -> Column:
    """One key for a block, no partitioning by page; the hash deals consecutive blocks out evenly, which their numbers do not."""
    return F.struct(doc_id.alias("doc_id"), page_no.alias("page_no"), block.alias("block"),
                    F.xxhash64(doc_id, page_no, block).alias("spread")).alias("_block")


def _tokens_by_block(words: DataFrame, params: RuleParams) -> DataFrame:
    tol, size = params.line_tolerance, params.block_words
    key = _block_key(*[F.col(c) for c in PAGE], F.expr(f"(ord - 1) div {size}"))
    blocks = staged(_collected(reading_order_split(words).withColumn("_block", key), ["_block"], ["ord"], words.columns)
                    .withColumn("ys", F.expr("transform(ws, w -> w.word.y0)")), "blocks")
    starts = blocks.join(_entered(blocks.select("_block", "ys"), size, tol), "_block").withColumn(
        "starts", F.expr(_starts("ys", "entered", tol)))
    opened = staged(starts.select("_block", "starts"), "line-starts")

    # Lines are counted down the page, over a row per block.
    before = Window.partitionBy(*[f"_block.{c}" for c in PAGE]).orderBy("_block.block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.expr(f"_block.block * {size} + element_at(starts, -1)")
    counted = opened.select(
        "_block", "starts", F.coalesce(F.sum(F.size("starts")).over(before), F.lit(0)).alias("base"),
        (F.expr(f"_block.block * {size} + 1") - F.max(F.when(F.size("starts") > 0, last)).over(before)).alias("open"))
    listed = _listed(blocks.select("_block", "ws").join(counted, "_block"), [], "base", "open")
    return listed.select(*[F.col("word")[c].alias(c) for c in words.columns], "line_no", "pos")


def _entered(blocks: DataFrame, size: int, tol: float) -> DataFrame:
    """(_block, entered): the baseline of the line that is open before each block (_block, ys), null before the first.

    A block of less than `size` words is the last of its page, so no block is entered from it.

    Known baselines grow until no line that passes through a block leaves with a new one; one pass shows that, unless
    lines pass without meeting, which takes a pass more for each block they stay apart.
    """
    full = blocks.where(F.size("ys") == size)
    moved = "(m + y) / 2"
    behind = _block_key(F.col("_block.doc_id"), F.col("_block.page_no"), F.col("_block.block") + 1)
    left = f"""aggregate(ys, CAST(array() AS ARRAY<DOUBLE>), (live, y) ->
        array_distinct(concat(transform(filter(live, m -> NOT abs(y - m) > {tol}D), m -> {moved}), array(y))))"""
    passed = f"""aggregate(ys, states, (live, y) ->
        array_distinct(transform(filter(live, m -> NOT abs(y - m) > {tol}D), m -> {moved})))"""
    known = fresh = staged(full.select(behind, F.expr(left).alias("states")), "baselines", plain=True)
    while True:
        further = full.join(fresh, "_block").select(behind, F.expr(passed).alias("states")).where("size(states) > 0")
        have = known.withColumnRenamed("states", "have")
        fresh = staged(further.join(have, "_block").select("_block", F.array_except("states", "have").alias("states"))
                       .where("size(states) > 0"), "baselines", plain=True)
        if fresh.isEmpty():
            break
        known = staged(known.unionAll(fresh).groupBy("_block").agg(F.array_distinct(F.flatten(F.collect_list("states"))).alias("states")),
                       "baselines", plain=True)

    leads = f"aggregate(ys, states, (live, y) -> transform(live, m -> IF(abs(y - m) > {tol}D, y, {moved})))"
    alone = f"aggregate(ys, CAST(NULL AS DOUBLE), (m, y) -> IF(m IS NULL OR abs(y - m) > {tol}D, y, {moved}))"
    steps = blocks.join(known, "_block", "left").select(
        "_block", "states", F.expr(leads).alias("leads"), F.expr(f"IF(_block.block = 0, {alone}, NULL)").alias("alone"))
    followed = """aggregate(steps, named_struct('at', CAST(NULL AS DOUBLE), 'entered', CAST(array() AS ARRAY<DOUBLE>)),
        (acc, s) -> named_struct('at', coalesce(s.alone, s.leads[CAST(array_position(s.states, acc.at) AS INT) - 1]),
                                 'entered', concat(acc.entered, array(acc.at))),
        acc -> acc.entered)"""
    step = F.struct(F.col("_block.block").alias("block"), "states", "leads", "alone")
    pages = steps.groupBy(*[F.col(f"_block.{c}").alias(c) for c in PAGE]).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    listed = pages.select(*PAGE, F.posexplode(F.expr(followed)).alias("block", "entered"))
    return listed.select(_block_key(*[F.col(c) for c in PAGE], F.col("block").cast("bigint")), "entered")
