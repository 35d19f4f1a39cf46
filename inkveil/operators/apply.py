"""Apply boxes to words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.functions.geometry import overlaps
from inkveil.operators.detect import BOX
from inkveil.operators.lines import PAGE
from inkveil.session import staged, union_all


@dataclass(frozen=True)
class Grid:
    """Cells, in points, on which words up to a size meet boxes."""

    cell_w: float
    cell_h: float
    word_w: float
    word_h: float


# A word is listed once: on the first grid made for its size, or on a last one with a single cell
# per page. A box is listed on every grid, in all cells from which a word can reach it.
GRIDS = (Grid(512.0, 64.0, 128.0, 16.0), Grid(4096.0, 1024.0, 1024.0, 256.0))
LAST_CELL = -1
# Parts that the words of a dense cell are dealt to; its boxes are listed in each.
PARTS = 64


def with_area(boxes: DataFrame) -> DataFrame:
    return boxes.filter((F.col("rx1") > F.col("rx0")) & (F.col("ry1") > F.col("ry0")))


def redaction_plan(text_boxes: DataFrame, region_boxes: DataFrame) -> DataFrame:
    """All boxes of all rules, found on the unredacted text, without those that cover nothing."""
    text = text_boxes.select(*PAGE, "rule", *BOX).distinct()
    fixed = region_boxes.select(*PAGE, F.lit("region").alias("rule"), *BOX).distinct()
    return union_all(with_area(text), with_area(fixed))


def kept_words(words: DataFrame, boxes: DataFrame, dense_rows: int | None = None) -> DataFrame:
    """Words that touch no box.

    dense_rows: cells with more words are dealt to parts, whatever their size. Cells are counted first then, so `words`
    should be a table. None where pages are known to be smaller.
    """
    return _meet(words, boxes, "left_anti", dense_rows)


def removed_words(words: DataFrame, boxes: DataFrame, dense_rows: int | None = None) -> DataFrame:
    """Words that touch a box, each once."""
    return _meet(words, boxes, "left_semi", dense_rows)


def _meet(words: DataFrame, boxes: DataFrame, how: str, dense_rows: int | None) -> DataFrame:
    """Semi or anti join on box overlap, as an equi join on page and cell plus the exact test."""
    cell = str(LAST_CELL)
    for level, g in reversed(list(enumerate(GRIDS))):
        here = _cell(level, f"floor((x0 + {g.word_w + 1}D) / {g.cell_w}D)",
                     f"floor((y0 + {g.word_h + 1}D) / {g.cell_h}D)")
        cell = f"IF(x1 - x0 <= {g.word_w}D AND y1 - y0 <= {g.word_h}D, {here}, {cell})"
    cells = ", ".join(_cells(level, g) for level, g in enumerate(GRIDS))
    left = words.withColumn("_cell", F.expr(f"CAST({cell} AS BIGINT)"))
    right = with_area(boxes).select(
        F.col("doc_id").alias("_doc_id"), F.col("page_no").alias("_page_no"), *BOX,
        F.explode(F.expr(f"concat(array({LAST_CELL}L), {cells})")).alias("_box_cell"))
    c = F.col
    touch = overlaps(c("x0"), c("y0"), c("x1"), c("y1"), *[c(b) for b in BOX])
    if dense_rows is not None:
        key = _place(c("doc_id"), c("page_no"), c("_cell"))
        dense = staged(left.groupBy(key.alias("_dense")).count().where(c("count") > dense_rows).select("_dense"), "dense-cells")
        if not dense.isEmpty():
            return _meet_in_parts(left, right, dense, touch, how).drop("_cell")
    on = (c("doc_id") == c("_doc_id")) & (c("page_no") == c("_page_no")) & (c("_cell") == c("_box_cell")) & touch
    return left.join(right, on, how).drop("_cell")


def _place(doc_id: Column, page_no: Column, cell: Column, *part: Column) -> Column:
    """One key, which no partitioning by page can stand in for; null, and equal to none, where a page has no name."""
    return F.when(doc_id.isNotNull() & page_no.isNotNull(), F.struct(
        doc_id.alias("doc_id"), page_no.alias("page_no"), cell.alias("cell"), *part))


def _meet_in_parts(left: DataFrame, right: DataFrame, dense: DataFrame, touch: Column, how: str) -> DataFrame:
    """The same join with the words of the dense cells dealt to parts and their boxes listed in each part.

    The dense cells (a row each) are found in the words by a key that has the part as well.
    """
    c = F.col
    part = F.pmod(F.xxhash64("word_idx"), F.lit(PARTS).cast("bigint"))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PARTS - 1).cast("bigint"))).alias("part")
    listed = dense.select("_dense.*", parts).select(_place(c("doc_id"), c("page_no"), c("cell"), c("part")).alias("_in"), F.lit(True).alias("_hit"))
    dealt = left.withColumn("_in", _place(c("doc_id"), c("page_no"), c("_cell"), part.alias("part"))).join(listed, "_in", "left")
    dealt = dealt.withColumn("_part", F.when(c("_hit"), c("_in.part")).otherwise(-1)).withColumn(
        "_at", _place(c("doc_id"), c("page_no"), c("_cell"), c("_part").alias("part"))).drop("_in", "_hit", "_part")
    box_key = _place(c("_doc_id"), c("_page_no"), c("_box_cell"))
    known = right.withColumn("_dense", box_key).join(dense.withColumn("_hit", F.lit(True)), "_dense", "left")
    several = F.when(c("_hit"), F.sequence(F.lit(0).cast("bigint"), F.lit(PARTS - 1).cast("bigint"))).otherwise(
        F.array(F.lit(-1).cast("bigint")))
    spread = known.withColumn("_box_part", F.explode(several)).select(
        *BOX, _place(c("_doc_id"), c("_page_no"), c("_box_cell"), c("_box_part").alias("part")).alias("_box_at"))
    return dealt.join(spread, (c("_at") == c("_box_at")) & touch, how).drop("_at")


def _cell(level: int, x: str, y: str) -> str:
    """One number per cell. Two cells may share one, as the exact test follows anyway."""
    return f"({level} + {len(GRIDS)} * ({x} + 1000003 * {y}))"


def _cells(level: int, g: Grid) -> str:
    """SQL for the cells in which a word that reaches a box may be listed.

    Such a word starts less than its own size before the box, and one point is to spare for float
    error; words are listed that much further on, so most boxes need a single cell.
    """
    xs = f"sequence(floor(rx0 / {g.cell_w}D), floor((rx1 + {g.word_w + 1}D) / {g.cell_w}D))"
    ys = f"sequence(floor(ry0 / {g.cell_h}D), floor((ry1 + {g.word_h + 1}D) / {g.cell_h}D))"
    return f"flatten(transform({xs}, x -> transform({ys}, y -> {_cell(level, 'x', 'y')})))"
