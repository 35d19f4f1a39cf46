"""Rendered pages as image rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.functions.geometry import pixel
from inkveil.operators.pages import RASTER_PAGE


UNREADABLE = "page image is not readable"


def read_rasters(spark: SparkSession, folder: str) -> DataFrame:
    """Images: (path, width, height, nChannels, data, error), pixels row by row.

    An image that cannot be decoded is a row with an error and without data.
    """
    read = spark.read.format("image").option("dropInvalid", False).load(folder).select(
        F.col("image.origin").alias("path"), "image.width", "image.height", "image.nChannels", "image.data")
    bad = F.coalesce((F.col("width") <= 0) | (F.col("height") <= 0) | (F.octet_length("data") == 0), F.lit(True))
    return read.select("path", *[F.when(~bad, F.col(c)).alias(c) for c in ("width", "height", "nChannels", "data")],
                       F.when(bad, F.lit(UNREADABLE)).alias("error"))


def image_errors(images: DataFrame) -> DataFrame:
    """(doc_id, error) of documents with an image that cannot be read; `images` has doc_id and error."""
    return images.where("error is not null").groupBy("doc_id").agg(F.min("error").alias("error"))


def image_boxes(images: DataFrame, regions: DataFrame, page_no: int = RASTER_PAGE) -> DataFrame:
    """The regions of a page number in the pixels of each image: (path, px0, py0, px1, py1)."""
    c = F.col
    sized = images.select("path", "width", "height", F.lit(page_no).alias("page_no"))
    return sized.join(regions, "page_no").select(
        "path", pixel(c("r0"), c("width")).alias("px0"), pixel(c("r1"), c("height")).alias("py0"),
        pixel(c("r2"), c("width")).alias("px1"), pixel(c("r3"), c("height")).alias("py1"))
