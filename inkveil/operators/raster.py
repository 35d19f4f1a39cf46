"""Blacking out boxes in rendered pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.functions.geometry import pixel


def burn_grid(pixels: Column, width: int, boxes: Column) -> Column:
    """A row-major array of pixels with every pixel inside a box set to 0.

    boxes: ARRAY<STRUCT<px0, py0, px1, py1>>, both corners inclusive.
    """
    def burn(value: Column, i: Column) -> Column:
        row, col = F.floor(i / width), i % width
        inside = F.exists(boxes, lambda b: col.between(b["px0"], b["px1"]) & row.between(b["py0"], b["py1"]))
        return F.when(inside, F.lit(0).cast("float")).otherwise(value)
    return F.transform(pixels, burn)


def published_images(images: DataFrame, regions: DataFrame) -> DataFrame:
    """Page images (doc_id, page_no, width, height, nChannels, data) with the regions of their page number burned.

    Images that cannot be read are not published; their documents are error rows of the audit.
    """
    c = F.col
    keyed = images.where(c("data").isNotNull()).withColumn("path", F.struct("doc_id", "page_no"))
    boxes = keyed.select("path", "page_no", "width", "height").join(regions, "page_no").select(
        "path", pixel(c("r0"), c("width")).alias("px0"), pixel(c("r1"), c("height")).alias("py0"),
        pixel(c("r2"), c("width")).alias("px1"), pixel(c("r3"), c("height")).alias("py1"))
    return burn_images(keyed, boxes.dropna()).select("doc_id", "page_no", "width", "height", "nChannels", "data")


def burn_images(images: DataFrame, boxes: DataFrame, key: str = "path") -> DataFrame:
    """Blacks out boxes in image rows (key, width, height, nChannels, data).

    boxes: (key, px0, py0, px1, py1), a handful per page. The image is cut into its pixel rows, the rows a box covers
    are overwritten, and the rows are put together again as bytes, in two steps of about the square root of their
    number: beside the image itself there are its parts and the result, and no row is copied more often than that.
    """
    listed = boxes.groupBy(key).agg(F.collect_list(F.struct("px0", "py0", "px1", "py1")).alias("boxes"))
    stride = F.col("width") * F.col("nChannels")
    none = F.array().cast("array<struct<px0:int,py0:int,px1:int,py1:int>>")
    rows = F.ceil(F.sqrt("height")).cast("int")  # of one part
    empty, last = F.lit("").cast("binary"), F.col("height") - 1

    def overwrite(line: Column, b: Column, y: Column) -> Column:
        left = F.greatest(b["px0"], F.lit(0))
        right = F.least(b["px1"], F.col("width") - 1)
        n = (right - left + 1) * F.col("nChannels")
        black = F.unhex(F.repeat(F.lit("00"), n))
        covered = y.between(b["py0"], b["py1"]) & (right >= left)
        return F.when(covered, F.overlay(line, black, left * F.col("nChannels") + 1, n)).otherwise(line)

    def scan_line(y: Column) -> Column:
        return F.aggregate("boxes", F.substring(F.col("data"), y * stride + 1, stride), lambda line, b: overwrite(line, b, y))

    def part(first: Column) -> Column:
        ys = F.sequence(first, F.least(first + rows - 1, last))
        return F.aggregate(ys, empty, lambda done, y: F.concat(done, scan_line(y)))

    parts = F.transform(F.sequence(F.lit(0), last, rows), part)
    return (
        images.join(listed, key, "left")
        .withColumn("boxes", F.coalesce("boxes", none))
        .withColumn("data", F.when(F.size("boxes") == 0, F.col("data"))
                    .otherwise(F.aggregate(parts, empty, lambda done, own: F.concat(done, own))))
        .drop("boxes")
    )
