"""Box arithmetic on flat double columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tenths(v: Column) -> Column:
    """round(v, 1) * 10, rounding half to even on the exact binary value as Python's round() does.

    v*10 = v*8 + v*2, where both products are exact, so the rounding error of the sum is known
    exactly and tells on which side of a tie the true value lies.
    """
    a, b = v * 8.0, v * 2.0
    s = a + b
    back = s - a
    err = (a - (s - back)) + (b - back)
    nearest_even = F.rint(s)
    tie = F.abs(s - nearest_even) == 0.5
    return F.when(tie & (err != 0), F.rint(s + F.signum(err) * 0.25)).otherwise(nearest_even)


def clamp01(v: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))


def absolute_edges(lo: Column, hi: Column, origin: Column, extent: Column) -> tuple[Column, Column]:
    """A relative interval on a page axis: clamped to the page, put in order, scaled to points."""
    a, b = clamp01(lo), clamp01(hi)
    return origin + extent * F.least(a, b), origin + extent * F.greatest(a, b)


def pixel(rel: Column, size: Column) -> Column:
    """A relative coordinate as a pixel index: truncated, neither clamped nor reordered; null beyond any image."""
    return (rel * size).try_cast("int")


def raster_size(points: Column, dpi: int) -> Column:
    """Pixels a renderer needs to cover a length: whole pixels outwards, ignoring 0.001 overshoot."""
    return F.ceil(points * (dpi / 72.0) - 0.001).cast("int")


def overlaps(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Boxes share some area; touching edges do not count."""
    return (ax0 < bx1) & (ax1 > bx0) & (ay0 < by1) & (ay1 > by0)
