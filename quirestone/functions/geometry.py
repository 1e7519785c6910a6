"""Boxes (arrays x0, y0, x1, y1) and reading-order intervals as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(*[c.cast("double") for c in (x0, y0, x1, y1)])


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def _ratio(shared: Column, whole: Column) -> Column:
    return F.when(whole > 0, shared / whole).otherwise(F.lit(0.0))


def overlap_by_smaller(a: Column, b: Column) -> Column:
    """Shared area by the smaller box; not the same as the two below."""
    return _ratio(intersection_area(a, b), F.least(area(a), area(b)))


def overlap_by_own(a: Column, b: Column) -> Column:
    """Share of ``a`` that lies in ``b``."""
    return _ratio(intersection_area(a, b), area(a))


def overlap_by_image(table: Column, image: Column) -> Column:
    """Share of an image that a table covers."""
    return _ratio(intersection_area(table, image), area(image))


def union_box(a: Column, b: Column) -> Column:
    return F.array(F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[2], b[2]), F.greatest(a[3], b[3]))


def center_inside(a: Column, b: Column, margin: float = 0.0) -> Column:
    x, y = (a[0] + a[2]) / 2, (a[1] + a[3]) / 2
    return (x >= b[0] - margin) & (x <= b[2] + margin) & (y >= b[1] - margin) & (y <= b[3] + margin)


def x_overlap(a: Column, b: Column) -> Column:
    """Shared width by the narrower box."""
    return _ratio(F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])), F.least(a[2] - a[0], b[2] - b[0]))


def vertical_gap(upper: Column, lower: Column) -> Column:
    return lower[1] - upper[3]


def scale_box(b: Column, sx: Column, sy: Column) -> Column:
    return F.array(F.round(b[0] * sx, 6), F.round(b[1] * sy, 6), F.round(b[2] * sx, 6), F.round(b[3] * sy, 6))


def expand_box(b: Column, width: Column, height: Column, share: float = 0.08, least: float = 8.0) -> Column:
    """Grown by a share of its size, at least ``least`` a side, inside the page."""
    dx, dy = F.greatest((b[2] - b[0]) * share, F.lit(least)), F.greatest((b[3] - b[1]) * share, F.lit(least))
    return F.array(F.greatest(F.lit(0.0), b[0] - dx), F.greatest(F.lit(0.0), b[1] - dy), F.least(width, b[2] + dx), F.least(height, b[3] + dy))


def position(page: Column, y: Column) -> Column:
    """A point in reading order; a missing height counts as the top of its page."""
    return F.struct(page.cast("long").alias("page"), F.coalesce(y.cast("double"), F.lit(0.0)).alias("y"))


def in_reading_range(page: Column, y: Column, start_page: Column, start_y: Column, end_page: Column, end_y: Column) -> Column:
    """``start <= (page, y) < end``; without an end height (null or 0) the whole end page is inside."""
    at = position(page, y)
    whole = end_y.isNull() | (end_y == 0)
    return (at >= position(start_page, start_y)) & F.when(whole, page <= end_page).otherwise(at < position(end_page, end_y))


def span_overlaps(page: Column, top: Column, bottom: Column, start_page: Column, start_y: Column, end_page: Column, end_y: Column) -> Column:
    """Whether the vertical extent of a box touches the range: tables use this, not their top point."""
    begins = F.when(page == start_page, bottom > F.coalesce(start_y, F.lit(0.0))).otherwise(page > start_page)
    whole = end_y.isNull() | (end_y == 0)
    ends = F.when(page == end_page, whole | (top < end_y)).otherwise(page < end_page)
    return begins & ends
