import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pvscan.functions import geo, kernels
from pvscan.operators import labels
from pyspark.sql import functions as F


def box(x1, y1, x2, y2):
    return [[np.array([(x1, y1), (x2, y1), (x2, y2), (x1, y2)], float)]]


def test_equal_area(spark):
    df = spark.createDataFrame([(6.0, 52.0, 6.001, 52.001), (6.0, 52.0, 6.0001, 52.0001)], "w double, s double, e double, n double")
    own = df.select(geo.box(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("geom"), geo.box_area_m2(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("closed"))
    rows = own.select(geo.area_m2(F.col("geom")).alias("a"), "closed").collect()
    assert rows[0].a == pytest.approx(7641.5, abs=1) and rows[1].a == pytest.approx(76.4, abs=0.1)
    assert all(r.a == pytest.approx(r.closed, rel=1e-6) for r in rows)
    assert geo.with_min_area(own, 1000).count() == 1


def test_holes_are_subtracted(spark):
    shell, hole = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    as_rows = lambda r: [{"x": float(x) / 1000, "y": float(y) / 1000} for x, y in r]
    df = spark.createDataFrame([([[as_rows(shell)]],), ([[as_rows(shell), as_rows(hole)]],)], f"geom {geo.GEOMETRY}")
    whole, less = [r[0] for r in df.select(geo.area_m2(F.col("geom"))).collect()]
    assert less == pytest.approx(whole * 15 / 16, rel=1e-3)


def test_zones_and_blocks(spark):
    df = spark.createDataFrame([(2.4, 48.9), (77.2, 28.6), (151.2, -33.8)], "x double, y double")
    assert [r[0] for r in df.select(geo.utm_epsg(F.col("x"), F.col("y"))).collect()] == [32631, 32643, 32756]
    tiles = spark.createDataFrame([("31UDQ",), ("43RGM",), ("56HLH",)], "t string")
    assert [r[0] for r in tiles.select(geo.tile_epsg(F.col("t"))).collect()] == [32631, 32643, 32756]
    blocks = spark.createDataFrame([(0.0, 0.0), (30_000.0, 0.0), (500.0, 0.0), (-1.0, 0.0)], "x double, y double")
    a, b, c, d = [r[0] for r in blocks.select(geo.block_id(F.col("x"), F.col("y"), 25)).collect()]
    assert a == c and a != b and d == -geo.BLOCK_FACTOR


def test_grid_covers_bounds(spark):
    cells = geo.bbox_grid(spark, (10.0, 47.0, 11.1, 48.3), 0.25).collect()
    assert len(cells) == 30 and max(c.east for c in cells) == 11.1 and max(c.north for c in cells) == 48.3


def test_tiles():
    found = kernels.tiles_for(box(11.40, 48.02, 11.58, 48.18))
    assert found == ["32TPU", "32UPU"]
    for tile in ("32UPU", "31UDQ", "43RGM", "56HLH"):
        border = kernels.tile_polygon(tile)
        assert kernels.tile_of(*border.mean(0)) == tile
        assert np.ptp(border[:, 0]) > 0.8
    assert kernels.utm_zone(5, 60) == 32 and kernels.utm_zone(10, 78) == 33
    e, n = kernels.to_utm(11.45, 48.1, 32)
    lon, lat = kernels.from_utm(e, n, 32)
    assert lon == pytest.approx(11.45, abs=1e-8) and lat == pytest.approx(48.1, abs=1e-8)


def test_polygon_kernels():
    a, b = box(0, 0, 2, 2), box(1, 1, 3, 3)
    assert kernels.union_area(a + b) == pytest.approx(7) and kernels.intersection_area(a, b) == pytest.approx(1)
    assert kernels.intersects(box(0, 0, 1, 1), box(1, 1, 2, 2)) and not kernels.intersects(box(0, 0, 1, 1), box(2, 2, 3, 3))
    assert kernels.intersects(box(0, 0, 9, 9), box(3, 3, 4, 4))
    assert kernels.distance(box(0, 0, 1, 1), box(4, 5, 6, 7)) == pytest.approx(5)
    diamond = [[np.array([(1, 0), (2, 1), (1, 2), (0, 1)], float)]]
    assert kernels.intersection_area(diamond, box(0, 0, 2, 1)) == pytest.approx(1)
    ring = [[a[0][0], box(0.5, 0.5, 1.5, 1.5)[0][0]]]
    assert kernels.union_area(ring) == pytest.approx(3)
    assert kernels.points_in_polygon(np.array([(0.2, 0.2), (1, 1), (0, 1)]), ring[0]).tolist() == [True, False, False]
    x, y = kernels.representative_point(ring[0])
    assert kernels.points_in_polygon(np.array([(x, y)]), ring[0])[0]


def test_joined_parts_share_more_than_a_point():
    a = box(0, 0, 2, 2)
    assert kernels.joined(a, box(2, 1, 4, 3)) and kernels.joined(a, box(1, 1, 5, 5)) and kernels.joined(a, box(0.5, 0.5, 1, 1))
    assert not kernels.joined(a, box(2, 2, 3, 3)) and not kernels.joined(a, box(5, 5, 6, 6))
    diamond = [[np.array([(3, 0), (4, 1), (3, 2), (2, 1)], float)]]
    assert kernels.intersects(a, diamond) and not kernels.joined(a, diamond)


def test_one_large_geometry_against_small_ones():
    ring = [[box(0, 0, 10, 10)[0][0], box(2, 2, 8, 8)[0][0]]]
    own = kernels.Prepared(ring)
    for other in (box(0.5, 0.5, 1, 1), box(4, 4, 5, 5), box(1, 1, 3, 3), box(-5, -5, 20, 20), box(10, 10, 11, 11), box(11, 0, 12, 1)):
        assert own.intersects(other) == kernels.intersects(ring, other)


def test_areas_inside_boxes_and_covered_points(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        n = int(rng.integers(4, 10))
        angle = (np.arange(n) + 0.8 * rng.random(n)) * 2 * np.pi / n  # no gap of a half turn, so borders don't cross
        shell = [(float(5 + r * np.cos(t)), float(5 + r * np.sin(t))) for r, t in zip(rng.uniform(1, 5, n), angle, strict=True)]
        w, s = rng.uniform(-1, 8, 2)
        rows.append(([[[{"x": x, "y": y} for x, y in [*shell, shell[0]]]]], float(w), float(s), float(w + rng.uniform(0.5, 6)), float(s + rng.uniform(0.5, 6))))
    rows.append((rows[0][0] + [[[{"x": x, "y": y} for x, y in r] for r in ([(20, 20), (30, 20), (30, 30), (20, 30)], [(22, 22), (24, 22), (24, 24), (22, 24)])]], 0.0, 0.0, 40.0, 23.0))
    rows = [([[[{"x": float(p["x"]), "y": float(p["y"])} for p in ring] for ring in poly] for poly in g], *b) for g, *b in rows]
    df = spark.createDataFrame(rows, f"shape {geo.GEOMETRY}, x1 double, y1 double, x2 double, y2 double")
    got = df.select("*", geo.clipped_area(F.col("shape"), *[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("inside"), geo.covers_point(F.col("shape"), F.col("x1") + 0.25, F.col("y1") + 0.125).alias("covers"), geo.planar_area(F.col("shape")).alias("whole")).collect()
    for r in got:
        shape = kernels.rings(r.shape)
        assert r.inside == pytest.approx(kernels.intersection_area(shape, box(r.x1, r.y1, r.x2, r.y2)), abs=1e-6)
        assert r.covers == any(kernels.points_in_polygon(np.array([(r.x1 + 0.25, r.y1 + 0.125)]), p)[0] for p in shape)
        assert r.whole == pytest.approx(kernels.union_area(shape), abs=1e-6)


boxes = st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8), st.integers(1, 5), st.integers(1, 5)), min_size=1, max_size=6)


@settings(max_examples=40, deadline=None)
@given(boxes, boxes)
def test_areas_like_counted_cells(a, b):
    cells = lambda bs: {(i, j) for x, y, w, h in bs for i in range(x, x + w) for j in range(y, y + h)}
    polys = lambda bs: [p for x, y, w, h in bs for p in box(x, y, x + w, y + h)]
    assert kernels.union_area(polys(a)) == pytest.approx(len(cells(a)))
    assert kernels.intersection_area(polys(a), polys(b)) == pytest.approx(len(cells(a) & cells(b)))
    assert labels.union_area(np.array([(x, y, x + w, y + h) for x, y, w, h in a], float)) == len(cells(a))
