"""Which pages are published, and as what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.operators.lines import LINE, PAGE, line_text
from inkveil.operators.regions import raster_pages
from inkveil.params import RuleParams
from inkveil.session import union_all

# Fixed value: the message of a document without pages.
NO_PAGES = "PDF must have at least 1 page"
TEXT_PAGE, RASTER_PAGE = 1, 2


def page_routing(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages per document and the path they take; a document without pages is an error."""
    counts = pages.groupBy("doc_id").agg(F.max("page_no").cast("bigint").alias("n_pages"))
    n = F.col("n_pages")
    return (
        documents.select("doc_id").join(counts, "doc_id", "left")
        .withColumn("n_pages", F.coalesce(n, F.lit(0).cast("bigint")))
        .withColumn("route", F.when(n == 0, "error").when(n == 1, "single").otherwise("multi"))
        .withColumn("error", F.when(n == 0, F.lit(NO_PAGES)))
    )


def page_policy(pages: DataFrame) -> DataFrame:
    """What becomes of each page: text, raster, or dropped."""
    n = F.col("page_no")
    return pages.select(
        "doc_id", "page_no",
        F.when(n == TEXT_PAGE, "text").when(n == RASTER_PAGE, "raster").otherwise("dropped").alias("outcome"))


def text_page(df: DataFrame) -> DataFrame:
    return df.filter(F.col("page_no") == TEXT_PAGE)


def raster_page(df: DataFrame) -> DataFrame:
    return df.filter(F.col("page_no") == RASTER_PAGE)


def redacted_text(kept_tokens: DataFrame) -> DataFrame:
    """The remaining text of each line; lines that lost all words are gone."""
    return line_text(kept_tokens)


def published_pages(kept_tokens: DataFrame, pages: DataFrame, params: RuleParams) -> DataFrame:
    """The output document: the redacted lines of page 1, and page 2 as an image without text.

    img_w and img_h are the image in pixels, which is the size of its page in points.
    """
    def empty(kind: str, *names: str) -> list[Column]:
        return [F.lit(None).cast(kind).alias(n) for n in names]

    lines = line_text(text_page(kept_tokens), F.count(F.lit(1)).alias("n_words"))
    text = lines.select(*LINE, F.lit("text").alias("kind"), F.col("line_text").alias("text"), "n_words",
                        *empty("int", "img_w", "img_h"))
    raster = raster_pages(raster_page(pages), params).select(
        *PAGE, *empty("int", "line_no"), F.lit("raster").alias("kind"), *empty("string", "text"),
        F.lit(0).cast("bigint").alias("n_words"), "img_w", "img_h")
    return union_all(text, raster)
