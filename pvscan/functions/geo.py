"""Geometry as built-in column expressions: equal-area projection, areas, zones, blocks, boxes.

A geometry column is ``array<array<array<struct<x: double, y: double>>>>``: polygons, their rings (the
first is the shell, others are holes), their points. Stored vectors are in degrees (WGS 84).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: WGS 84 and the standard parallel of the cylindrical equal-area grid (fixed values).
A = 6378137.0
INV_F = 298.257223563
PARALLEL = 30.0
E2 = (2 - 1 / INV_F) / INV_F
_E = math.sqrt(E2)
_K0 = math.cos(math.radians(PARALLEL)) / math.sqrt(1 - E2 * math.sin(math.radians(PARALLEL)) ** 2)
#: Factor of the block id's x part (fixed value).
BLOCK_FACTOR = 1_000_003

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"


def equal_area_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(A * _K0)


def equal_area_y(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    e = F.lit(_E)
    q = F.lit(1 - E2) * (s / (F.lit(1.0) - F.lit(E2) * s * s) - F.log((F.lit(1.0) - e * s) / (F.lit(1.0) + e * s)) / F.lit(2 * _E))
    return q * F.lit(A / (2 * _K0))


def _ring_area(ring: Column) -> Column:
    """Absolute shoelace area of a ring of projected points; closed or not. Taken from its first point, to keep digits."""
    n = F.size(ring)
    o = F.get(ring, 0)
    at = lambda i: F.get(ring, i % n)
    step = F.transform(ring, lambda p, i: (p["x"] - o["x"]) * (at(i + 1)["y"] - o["y"]) - (at(i + 1)["x"] - o["x"]) * (p["y"] - o["y"]))
    return F.abs(F.aggregate(step, F.lit(0.0), lambda s, x: s + x)) / 2


def projected(geom: Column) -> Column:
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: F.struct(equal_area_x(p["x"]).alias("x"), equal_area_y(p["y"]).alias("y")))))


def area_m2(geom: Column) -> Column:
    """Equal-area square metres of a geometry in degrees; holes don't count."""
    polygon = lambda poly: F.aggregate(F.transform(poly, lambda ring, i: F.when(i == 0, _ring_area(ring)).otherwise(-_ring_area(ring))), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(F.transform(projected(geom), polygon), F.lit(0.0), lambda s, x: s + x)


def box_area_m2(west: Column, south: Column, east: Column, north: Column) -> Column:
    """The same for a box in degrees, in closed form."""
    return (equal_area_x(east) - equal_area_x(west)) * (equal_area_y(north) - equal_area_y(south))


def planar_area(shape: Column) -> Column:
    """Area of a geometry in its own plane; holes don't count."""
    polygon = lambda poly: F.aggregate(F.transform(poly, lambda ring, i: F.when(i == 0, _ring_area(ring)).otherwise(-_ring_area(ring))), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(F.transform(shape, polygon), F.lit(0.0), lambda s, x: s + x)


def _half(ring: Column, axis: str, bound: Column, sign: int) -> Column:
    """The part of a ring where sign * coordinate <= sign * bound, by walking its edges."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: (p[axis] <= bound) if sign > 0 else (p[axis] >= bound)

    def edge(p: Column, i: Column) -> Column:
        def walked(q: Column) -> Column:
            t = (bound - p[axis]) / (q[axis] - p[axis])
            cut = {axis: bound.cast("double"), other: p[other] + t * (q[other] - p[other])}
            return F.array(F.when(inside(p), p), F.when(inside(p) != inside(q), F.struct(cut["x"].alias("x"), cut["y"].alias("y"))))

        return F.get(F.transform(F.array(F.get(ring, (i + 1) % F.size(ring))), walked), 0)

    return F.filter(F.flatten(F.transform(ring, edge)), lambda p: p.isNotNull())


def clipped_area(shape: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Area of the part of a geometry inside a box, in its own plane: each ring is cut at the box's four sides."""
    step = lambda value, then: F.get(F.transform(F.array(value), then), 0)

    def ring_area(ring: Column) -> Column:
        def area(r: Column) -> Column:
            return F.when(F.size(r) >= 3, _ring_area(r)).otherwise(0.0)

        return step(_half(ring, "x", x1, -1), lambda a: step(_half(a, "x", x2, 1), lambda b: step(_half(b, "y", y1, -1), lambda c: step(_half(c, "y", y2, 1), area))))

    polygon = lambda poly: F.aggregate(F.transform(poly, lambda ring, i: F.when(i == 0, ring_area(ring)).otherwise(-ring_area(ring))), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(F.transform(shape, polygon), F.lit(0.0), lambda s, x: s + x)


def covers_point(shape: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside a geometry: even-odd rule over the rings of each polygon. Points on a border count for the polygon above or right of it."""

    def crossings(ring: Column) -> Column:
        def crossed(p: Column, i: Column) -> Column:
            q = F.get(ring, (i + 1) % F.size(ring))
            return F.when(((p["y"] > y) != (q["y"] > y)) & (x < p["x"] + (y - p["y"]) / (q["y"] - p["y"]) * (q["x"] - p["x"])), 1).otherwise(0)

        return F.aggregate(F.transform(ring, crossed), F.lit(0), lambda s, k: s + k)

    return F.exists(shape, lambda poly: F.aggregate(F.transform(poly, crossings), F.lit(0), lambda s, k: s + k) % 2 == 1)


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(F.array(p(x1, y1), p(x2, y1), p(x2, y2), p(x1, y2), p(x1, y1))))


def bbox(geom: Column) -> Column:
    """struct<x1, y1, x2, y2> around all shells."""
    points = F.flatten(F.flatten(geom))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def bbox_overlaps(box_column: str, west: float, south: float, east: float, north: float) -> Column:
    """Closed overlap of a struct<xmin, xmax, ymin, ymax> with bounds; reaches the scan's pushed filters."""
    c = lambda f: F.col(f"{box_column}.{f}")
    return (c("xmin") <= east) & (c("xmax") >= west) & (c("ymin") <= north) & (c("ymax") >= south)


def centroid(geom: Column) -> Column:
    """Area centroid of the first polygon's shell, in its own plane."""
    ring = F.get(F.get(geom, 0), 0)
    n = F.size(ring)
    cross = lambda p, i: p["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * p["y"]
    total = lambda f: F.aggregate(F.transform(ring, f), F.lit(0.0), lambda s, x: s + x)
    twice = total(cross)
    cx = total(lambda p, i: (p["x"] + F.get(ring, (i + 1) % n)["x"]) * cross(p, i))
    cy = total(lambda p, i: (p["y"] + F.get(ring, (i + 1) % n)["y"]) * cross(p, i))
    return F.struct((cx / (3 * twice)).alias("x"), (cy / (3 * twice)).alias("y"))


def with_min_area(df: DataFrame, least: float, geom: str = "geom", out: str = "area_m2") -> DataFrame:
    """Adds the area and keeps rows of at least ``least`` square metres."""
    return df.withColumn(out, area_m2(F.col(geom))).where(F.col(out) >= least)


def utm_epsg(lon: Column, lat: Column) -> Column:
    return (F.when(lat >= 0, 32600).otherwise(32700) + F.floor((lon + 180) / 6) + 1).cast("bigint")


def tile_epsg(tile: Column) -> Column:
    """EPSG code of a grid tile id such as 32ULB; bands from N on are northern."""
    zone = F.regexp_extract(tile, r"^(\d+)", 1).cast("bigint")
    band = F.upper(F.regexp_extract(tile, r"^\d+([A-Za-z])", 1))
    return F.when(band >= "N", 32600).otherwise(32700) + zone


def block_id(x: Column, y: Column, km: float) -> Column:
    size = F.lit(km * 1000.0)
    return F.floor(x / size).cast("bigint") * BLOCK_FACTOR + F.floor(y / size).cast("bigint")


def bbox_grid(spark, bounds: Sequence[float], step: float) -> DataFrame:
    """Cells of at most ``step`` covering the bounds, the last of each row and column clipped."""
    w, s, e, n = bounds
    cells = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.ceil(F.lit((e - w) / step - 1e-9)).cast("int") - 1)).alias("ix"))
    cells = cells.select("ix", F.explode(F.sequence(F.lit(0), F.ceil(F.lit((n - s) / step - 1e-9)).cast("int") - 1)).alias("iy"))
    at = lambda o, i, most: F.least(F.lit(o) + i * F.lit(step), F.lit(float(most)))
    return cells.select("ix", "iy", at(w, F.col("ix"), e).alias("west"), at(s, F.col("iy"), n).alias("south"), at(w, F.col("ix") + 1, e).alias("east"), at(s, F.col("iy") + 1, n).alias("north"))


def ring(points: Column) -> Column:
    """A ring of struct<lat, lon> as one of struct<x, y>; null unless closed and of four points at least."""
    xy = F.transform(points, lambda p: F.struct(p["lon"].cast("double").alias("x"), p["lat"].cast("double").alias("y")))
    return F.when((F.size(points) >= 4) & (F.element_at(points, 1) == F.element_at(points, -1)), xy)
