"""Fixed page regions as boxes in points or pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.functions.geometry import absolute_edges, pixel, raster_size
from inkveil.params import RuleParams


def fixed_boxes(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """Every region of a page number on every such page, in points; regions off the page have no area."""
    c = F.col
    x0, x1 = absolute_edges(c("r0"), c("r2"), c("bx0"), c("width"))
    y0, y1 = absolute_edges(c("r1"), c("r3"), c("by0"), c("height"))
    return pages.join(regions, "page_no").select(
        "doc_id", "page_no", "region_id",
        x0.alias("rx0"), y0.alias("ry0"), x1.alias("rx1"), y1.alias("ry1"))


def raster_pages(pages: DataFrame, params: RuleParams) -> DataFrame:
    """Rendered size of each page in pixels; it becomes the size of the output page in points."""
    return pages.select(
        "doc_id", "page_no",
        raster_size(F.col("width"), params.dpi).alias("img_w"),
        raster_size(F.col("height"), params.dpi).alias("img_h"))


def pixel_boxes(rasters: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions in pixels, both corners inclusive; they may lie outside the image."""
    c = F.col
    return rasters.join(regions, "page_no").select(
        "doc_id", "page_no", "region_id",
        pixel(c("r0"), c("img_w")).alias("px0"), pixel(c("r1"), c("img_h")).alias("py0"),
        pixel(c("r2"), c("img_w")).alias("px1"), pixel(c("r3"), c("img_h")).alias("py1"))
