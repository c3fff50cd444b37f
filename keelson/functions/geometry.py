"""Planar geometry as column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def polar_to_cartesian(angle_deg, distance) -> tuple[Column, Column]:
    """(x, y) of a point given in degrees and distance: x = cos(rad)*d, y = sin(rad)*d."""
    rad = F.radians(_c(angle_deg))
    d = _c(distance)
    return F.cos(rad) * d, F.sin(rad) * d


def vector_length(x, y) -> Column:
    # sqrt(x*x + y*y), not hypot: hypot rounds differently from the plain formula
    return F.sqrt(_c(x) * _c(x) + _c(y) * _c(y))


def vector_delta(x1, y1, x2, y2) -> tuple[Column, Column]:
    """Component-wise (x1 - x2, y1 - y2)."""
    return _c(x1) - _c(x2), _c(y1) - _c(y2)


def vector_add(x1, y1, x2, y2) -> tuple[Column, Column]:
    return _c(x1) + _c(x2), _c(y1) + _c(y2)


def vector_distance(x1, y1, x2, y2) -> Column:
    dx, dy = vector_delta(x1, y1, x2, y2)
    return vector_length(dx, dy)


def vector_angle(x, y) -> Column:
    """atan2(y, x) in radians."""
    return F.atan2(_c(y), _c(x))
