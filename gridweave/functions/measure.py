"""Lengths and areas of coordinate columns as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridweave.functions.geometry import EARTH_M


def haversine(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Great-circle metres between points in degrees."""
    a, b = F.radians(lat0), F.radians(lat1)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon1 - lon0) / 2), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (2 * EARTH_M)


def _segments(xs: Column, ys: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(xs) - 2), lambda i: F.struct(F.get(xs, i).alias("x0"), F.get(ys, i).alias("y0"), F.get(xs, i + 1).alias("x1"), F.get(ys, i + 1).alias("y1")))


def _total(xs: Column, segments: Column, each) -> Column:  # noqa: ANN001
    return F.when(F.size(xs) > 1, F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + each(s))).otherwise(0.0)


def haversine_length(lons: Column, lats: Column) -> Column:
    """Great-circle metres along a path of degrees."""
    return _total(lons, _segments(lons, lats), lambda s: haversine(s["x0"], s["y0"], s["x1"], s["y1"]))


def planar_length(xs: Column, ys: Column) -> Column:
    return _total(xs, _segments(xs, ys), lambda s: F.sqrt(F.pow(s["x1"] - s["x0"], 2) + F.pow(s["y1"] - s["y0"], 2)))


def ring_area(xs: Column, ys: Column) -> Column:
    """Area of a closed ring (shoelace)."""
    return F.abs(_total(xs, _segments(xs, ys), lambda s: s["x0"] * s["y1"] - s["x1"] * s["y0"])) / 2
