"""Geometry that built-in expressions can't say: polygons with holes, and the national grid, in numpy.

Polygons are lists of rings of points (x, y), the first ring being the shell; geometries are lists of polygons.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

Ring = np.ndarray


def rings(geom) -> list[list[Ring]]:
    """Numpy rings of a geometry column's value."""
    return [[np.array([(p["x"], p["y"]) for p in ring], float) for ring in poly] for poly in geom]


def _edges(polygon: list[Ring]) -> np.ndarray:
    """Rows x1, y1, x2, y2 of all rings, closed."""
    return np.concatenate([np.hstack([r, np.roll(r, -1, 0)]) for r in polygon])


def points_in_polygon(points: np.ndarray, polygon: list[Ring]) -> np.ndarray:
    """Which points are strictly inside: even-odd rule over all rings, none on an edge."""
    e = _edges(polygon)
    x, y = points[:, 0:1], points[:, 1:2]
    x1, y1, x2, y2 = e.T
    crosses = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        right = x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    inside = (crosses & right).sum(1) % 2 == 1
    return inside & ~_on_edges(points, e)


def _on_edges(points: np.ndarray, e: np.ndarray) -> np.ndarray:
    x, y = points[:, 0:1], points[:, 1:2]
    x1, y1, x2, y2 = e.T
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    between = (x >= np.minimum(x1, x2)) & (x <= np.maximum(x1, x2)) & (y >= np.minimum(y1, y2)) & (y <= np.maximum(y1, y2))
    return ((cross == 0) & between).any(1)


def _segments_meet(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether some edge of a and some edge of b share a point."""
    p, q = a[:, None, :], b[None, :, :]

    def side(ax, ay, bx, by, cx, cy):
        return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    d1 = side(p[..., 0], p[..., 1], p[..., 2], p[..., 3], q[..., 0], q[..., 1])
    d2 = side(p[..., 0], p[..., 1], p[..., 2], p[..., 3], q[..., 2], q[..., 3])
    d3 = side(q[..., 0], q[..., 1], q[..., 2], q[..., 3], p[..., 0], p[..., 1])
    d4 = side(q[..., 0], q[..., 1], q[..., 2], q[..., 3], p[..., 2], p[..., 3])
    boxes = (np.maximum(p[..., 0], p[..., 2]) >= np.minimum(q[..., 0], q[..., 2])) & (np.maximum(q[..., 0], q[..., 2]) >= np.minimum(p[..., 0], p[..., 2])) & (np.maximum(p[..., 1], p[..., 3]) >= np.minimum(q[..., 1], q[..., 3])) & (np.maximum(q[..., 1], q[..., 3]) >= np.minimum(p[..., 1], p[..., 3]))
    return bool((boxes & (d1 * d2 <= 0) & (d3 * d4 <= 0)).any())


def intersects(a: list[list[Ring]], b: list[list[Ring]]) -> bool:
    """Closed: a common point on a border is enough."""
    for p in a:
        for q in b:
            if _segments_meet(_edges(p), _edges(q)) or points_in_polygon(p[0][:1], q).any() or points_in_polygon(q[0][:1], p).any():
                return True
    return False


def _spans(polygons: list[list[Ring]], y: float) -> list[tuple[float, float]]:
    """Disjoint x intervals of the union of polygons on a horizontal line."""
    own = []
    for polygon in polygons:
        e = _edges(polygon)
        hit = e[(e[:, 1] > y) != (e[:, 3] > y)]
        xs = np.sort((hit[:, 2] - hit[:, 0]) * (y - hit[:, 1]) / (hit[:, 3] - hit[:, 1]) + hit[:, 0])
        own += list(zip(xs[::2], xs[1::2], strict=True))
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(own):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _crossings(edges: np.ndarray) -> np.ndarray:
    """Heights at which two edges cross."""
    p, q = edges[:, None, :], edges[None, :, :]
    d = (p[..., 2] - p[..., 0]) * (q[..., 3] - q[..., 1]) - (p[..., 3] - p[..., 1]) * (q[..., 2] - q[..., 0])
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((q[..., 0] - p[..., 0]) * (q[..., 3] - q[..., 1]) - (q[..., 1] - p[..., 1]) * (q[..., 2] - q[..., 0])) / d
        u = ((q[..., 0] - p[..., 0]) * (p[..., 3] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (p[..., 2] - p[..., 0])) / d
    ok = (d != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
    return (p[..., 1] + t * (p[..., 3] - p[..., 1]))[ok]


def _slab_area(groups: list[list[list[Ring]]]) -> float:
    """Area common to all groups of polygons (each group a union), by horizontal slabs between corners and crossings.

    Inside a slab all borders are straight and don't cross, so its area is its height times its middle line's length.
    """
    if any(not g for g in groups):
        return 0.0
    edges = np.concatenate([_edges(p) for g in groups for p in g])
    ys = np.unique(np.concatenate([edges[:, 1], edges[:, 3], _crossings(edges)]))
    total = 0.0
    for lo, hi in zip(ys, ys[1:], strict=False):
        spans = _spans(groups[0], (lo + hi) / 2)
        for g in groups[1:]:
            spans = [(max(a, c), min(b, d)) for a, b in spans for c, d in _spans(g, (lo + hi) / 2) if max(a, c) < min(b, d)]
        total += (hi - lo) * sum(b - a for a, b in spans)
    return float(total)


def union_area(polygons: list[list[Ring]]) -> float:
    return _slab_area([polygons])


def intersection_area(a: list[list[Ring]], b: list[list[Ring]]) -> float:
    return _slab_area([a, b])


def distance(a: list[list[Ring]], b: list[list[Ring]]) -> float:
    """0 if they meet, else the least distance between a corner and an edge."""
    if intersects(a, b):
        return 0.0

    def one_way(points: np.ndarray, e: np.ndarray) -> float:
        d = e[:, 2:] - e[:, :2]
        length = np.maximum((d * d).sum(1), 1e-300)
        t = np.clip(((points[:, None, :] - e[None, :, :2]) * d).sum(2) / length, 0, 1)
        return float(np.sqrt((((e[None, :, :2] + t[..., None] * d) - points[:, None, :]) ** 2).sum(2)).min())

    ea, eb = np.concatenate([_edges(p) for p in a]), np.concatenate([_edges(p) for p in b])
    return min(one_way(ea[:, :2], eb), one_way(eb[:, :2], ea))


def joined(a: list[list[Ring]], b: list[list[Ring]]) -> bool:
    """Whether two geometries overlap or share a piece of border, not only points."""
    for p in a:
        for q in b:
            if _share_border(_edges(p), _edges(q)) or (_segments_meet(_edges(p), _edges(q)) and intersection_area([p], [q]) > 0):
                return True
            if points_in_polygon(p[0][:1], q).any() or points_in_polygon(q[0][:1], p).any():
                return True
    return False


def _share_border(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether some edges lie on one line and overlap in more than a point."""
    p, q = a[:, None, :], b[None, :, :]
    dx, dy = p[..., 2] - p[..., 0], p[..., 3] - p[..., 1]
    on = lambda i, j: dx * (q[..., j] - p[..., 1]) - dy * (q[..., i] - p[..., 0]) == 0
    along = lambda i, j: (q[..., i] - p[..., 0]) * dx + (q[..., j] - p[..., 1]) * dy
    t, u, size = along(0, 1), along(2, 3), dx * dx + dy * dy
    return bool((on(0, 1) & on(2, 3) & (np.minimum(np.maximum(t, u), size) > np.maximum(np.minimum(t, u), 0))).any())


class Prepared:
    """One large geometry that many small ones are tested against."""

    def __init__(self, geom: list[list[Ring]]) -> None:
        self.polygons, self.edges = geom, [_edges(p) for p in geom]

    def intersects(self, other: list[list[Ring]]) -> bool:
        points = np.concatenate([r for p in other for r in p])
        (w, s), (e, n) = points.min(0), points.max(0)
        for polygon, own in zip(self.polygons, self.edges, strict=True):
            near = own[(np.maximum(own[:, 0], own[:, 2]) >= w) & (np.minimum(own[:, 0], own[:, 2]) <= e) & (np.maximum(own[:, 1], own[:, 3]) >= s) & (np.minimum(own[:, 1], own[:, 3]) <= n)]
            if any(points_in_polygon(p[0][:1], polygon).any() for p in other):
                return True
            if len(near) and any(_segments_meet(_edges(p), near) or points_in_polygon(near[:1, :2], p).any() for p in other):
                return True
        return False


def representative_point(polygon: list[Ring]) -> tuple[float, float]:
    """A point surely inside: the middle of the widest span half way up."""
    ys = polygon[0][:, 1]
    y = (ys.min() + ys.max()) / 2
    if (ys == y).any():
        above = ys[ys > y]
        y = (y + above.min()) / 2 if len(above) else y
    a, b = max(_spans([polygon], y), key=lambda s: s[1] - s[0])
    return (a + b) / 2, y


@F.pandas_udf(BooleanType())
def geom_intersects(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([intersects(rings(x), rings(y)) for x, y in zip(a, b, strict=True)], dtype=bool)


@F.pandas_udf(DoubleType())
def geom_overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([intersection_area(rings(x), rings(y)) for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def geom_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([distance(rings(x), rings(y)) for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(BooleanType())
def geom_joined(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([joined(rings(x), rings(y)) for x, y in zip(a, b, strict=True)], dtype=bool)


#: Third flattening of WGS 84, scale and false origin of UTM, and the grid's letters (fixed values).
_N = 1 / (2 * 298.257223563 - 1)
_SCALE, _FALSE_E, _FALSE_N = 0.9996, 500_000.0, 10_000_000.0
_RADIUS = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
BANDS = "CDEFGHJKLMNPQRSTUVWX"
COLUMNS = ("ABCDEFGH", "JKLMNPQR", "STUVWXYZ")
ROWS = "ABCDEFGHJKLMNPQRSTUV"


def utm_zone(lon: float, lat: float) -> int:
    """With the exceptions of south-western Norway and of Svalbard."""
    zone = int((lon + 180) // 6) % 60 + 1
    if 56 <= lat < 64 and 3 <= lon < 12:
        return 32
    if 72 <= lat <= 84 and 0 <= lon < 42:
        return 31 if lon < 9 else 33 if lon < 21 else 35 if lon < 33 else 37
    return zone


def to_utm(lon, lat, zone: int):
    """Easting and northing by Krueger's series; northings of the southern hemisphere are negative."""
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (6 * zone - 183))
    k = 2 * math.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - k * np.arctanh(k * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    e = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    n = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return _FALSE_E + _SCALE * _RADIUS * e, _SCALE * _RADIUS * n


def from_utm(easting, northing, zone: int):
    """Longitude and latitude; southern northings are negative."""
    xi, eta = np.asarray(northing) / (_SCALE * _RADIUS), (np.asarray(easting) - _FALSE_E) / (_SCALE * _RADIUS)
    x = xi - sum(b * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    y = eta - sum(b * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    chi = np.arcsin(np.sin(x) / np.cosh(y))
    phi = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return np.degrees(np.arctan2(np.sinh(y), np.cos(x))) + 6 * zone - 183, np.degrees(phi)


def tile_of(lon: float, lat: float) -> str:
    """Id of the 100 km square of the military grid, such as 32ULB."""
    zone = utm_zone(lon, lat)
    e, n = to_utm(lon, lat, zone)
    band = BANDS[min(max(int((lat + 80) // 8), 0), 19)]
    column = COLUMNS[(zone - 1) % 3][int(e // 100_000) - 1]
    row = ROWS[int(n // 100_000 + (5 if zone % 2 == 0 else 0)) % 20]
    return f"{zone:02d}{band}{column}{row}"


def tile_corner(tile: str) -> tuple[int, float, float]:
    """Zone, easting and northing (negative in the south) of a tile's south-western corner."""
    zone, band, column, row = int(tile[:-3]), tile[-3], tile[-2], tile[-1]
    e = 100_000.0 * (COLUMNS[(zone - 1) % 3].index(column) + 1)
    low = -80 + 8 * BANDS.index(band)
    base = (ROWS.index(row) - (5 if zone % 2 == 0 else 0)) % 20
    least = float(to_utm(6 * zone - 183, low, zone)[1]) - 100_000
    k = math.ceil((least / 100_000 - base) / 20)
    return zone, e, 100_000.0 * (base + 20 * k)


def tile_polygon(tile: str, step: float = 5_000.0) -> Ring:
    """A tile's border in degrees, with a point every ``step`` metres."""
    zone, e, n = tile_corner(tile)
    d = np.arange(0, 100_000, step)
    full = np.full_like(d, 100_000.0)
    x = np.concatenate([d, full, full - d, 0 * d, [0.0]]) + e
    y = np.concatenate([0 * d, d, full, full - d, [0.0]]) + n
    return np.column_stack(from_utm(x, y, zone))


def tiles_for(geom: list[list[Ring]], step: float = 0.1, buffer: float = 0.05) -> list[str]:
    """Sorted ids of tiles sampled every ``step`` degrees, and at zone borders, over the geometry grown by ``buffer``."""
    shell = np.concatenate([p[0] for p in geom])
    (w, s), (e, n) = shell.min(0) - buffer, shell.max(0) + buffer
    xs = np.unique(np.concatenate([np.arange(w, e + step, step), [x + o for x in np.arange(6 * math.floor(w / 6), e + 6, 6) for o in (-1e-6, 1e-6)]]))
    ys = np.arange(s, n + step, step)
    points = np.array([(x, y) for x in xs if w <= x <= e + step for y in ys])
    near = np.zeros(len(points), bool)
    for polygon in geom:
        near |= points_in_polygon(points, polygon)
        edges = _edges(polygon)
        d = edges[:, 2:] - edges[:, :2]
        length = np.maximum((d * d).sum(1), 1e-300)
        for lo in range(0, len(points), 4096):
            own = points[lo : lo + 4096]
            t = np.clip(((own[:, None, :] - edges[None, :, :2]) * d).sum(2) / length, 0, 1)
            near[lo : lo + 4096] |= ((((edges[None, :, :2] + t[..., None] * d) - own[:, None, :]) ** 2).sum(2) <= buffer**2).any(1)
    return sorted({tile_of(x, y) for x, y in points[near]})


@F.pandas_udf(StringType())
def tile_id(lon: pd.Series, lat: pd.Series) -> pd.Series:
    return pd.Series([tile_of(x, y) for x, y in zip(lon, lat, strict=True)], dtype=object)
