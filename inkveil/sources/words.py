"""Word tables: read from Parquet, or laid out from plain text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SCHEMA = (
    "doc_id BIGINT, page_no INT, word_idx BIGINT, "
    "x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, text STRING"
)
PAGE_SCHEMA = "doc_id BIGINT, page_no INT, bx0 DOUBLE, by0 DOUBLE, width DOUBLE, height DOUBLE"


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """A positioned-word table written by a text extractor."""
    return spark.read.schema(WORD_SCHEMA).parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


BLANKS = " \n\t\r"


@dataclass(frozen=True)
class TextLayout:
    """A fixed grid of words in points; the baseline jitters so that lines must be found."""

    cols: int = 10
    rows: int = 60
    margin: float = 36.0
    col_pitch: float = 52.0
    row_pitch: float = 12.0
    char_width: float = 5.0
    max_chars: int = 10
    word_height: float = 9.0
    jitter: float = 0.0625
    page_width: float = 595.0
    page_height: float = 842.0
    colon_every: int = 0  # append ':' to every n-th word; 0 leaves the text as it is

    @property
    def words_per_page(self) -> int:
        """No page can hold more words than this."""
        return self.cols * self.rows


def _tokens(text: Column) -> Column:
    """The blank-separated tokens, or null where there are none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, f"[{BLANKS}]+"))


def text_words(documents: DataFrame, layout: TextLayout = TextLayout()) -> DataFrame:
    """(doc_id, text) -> positioned words of the whole text, one output row per word."""
    i, n = F.col("i"), layout.words_per_page
    marked = F.col("token")
    if layout.colon_every:
        marked = F.when(i % layout.colon_every == 0, F.concat("token", F.lit(":"))).otherwise(marked)
    # The outer form keeps Spark from splitting the text a second time to test for emptiness.
    placed = (
        documents.select("doc_id", F.posexplode_outer(_tokens(F.col("text"))).alias("i", "token"))
        .filter(F.col("i").isNotNull())
        .select(
            "doc_id",
            F.expr(f"CAST(i DIV {n} + 1 AS INT)").alias("page_no"),
            i.cast("bigint").alias("word_idx"),
            (layout.margin + layout.col_pitch * (i % layout.cols)).alias("x0"),
            (layout.margin + layout.row_pitch * F.expr(f"(i DIV {layout.cols}) % {layout.rows}")
             + ((i * 7) % 5) * layout.jitter).alias("y0"),
            marked.alias("text"),
        )
    )
    width = layout.char_width * F.least(F.length("text"), F.lit(layout.max_chars))
    return placed.select(
        "doc_id", "page_no", "word_idx", "x0", "y0",
        (F.col("x0") + width).alias("x1"), (F.col("y0") + layout.word_height).alias("y1"), "text",
    )


def text_pages(documents: DataFrame, layout: TextLayout = TextLayout()) -> DataFrame:
    """The pages text_words() fills, with their bounds; a text without words has none."""
    # size() of null is null or -1, depending on spark.sql.ansi.enabled; neither makes a page.
    n = F.size(_tokens(F.col("text")))
    last = F.ceil(F.when(n > 0, n) / layout.words_per_page).cast("int")
    # As above: the outer form, and a test of its result, count the words of a text only once.
    numbered = documents.select("doc_id", F.explode_outer(F.sequence(F.lit(1), last)).alias("page_no"))
    return numbered.filter(F.col("page_no").isNotNull()).select(
        "doc_id", "page_no", F.lit(0.0).alias("bx0"), F.lit(0.0).alias("by0"),
        F.lit(layout.page_width).alias("width"), F.lit(layout.page_height).alias("height"))
