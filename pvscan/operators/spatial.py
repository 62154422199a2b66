"""Spatial joins on boxes by an equi-join on grid cells.

Each box goes to the cells it touches on a grid of its own level: cells of ``cell * 2**level``, the least level at
which it spans at most two in each direction, so at most four rows stand for a box of any size. It also
goes to the coarser levels that the other side has; a pair meets on the coarser of its two levels, and
only in the cell that holds the lower corner of the overlap: once, without a distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BOX = ("x1", "y1", "x2", "y2")


def _level(cell: float, pad: float) -> Column:
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).cast("double") + 2 * pad
    return F.greatest(F.ceil(F.log2(F.greatest(side, F.lit(cell)) / F.lit(cell))), F.lit(0)).cast("int")


def _celled(df: DataFrame, own: str, levels: list[int], cell: float, pad: float) -> DataFrame:
    df = df.withColumn(own, _level(cell, pad))
    at = F.explode(F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: x >= F.col(own)))
    df = df.withColumn("__level", at).withColumn("__size", F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("__level")))
    span = lambda a, b: F.sequence(F.floor((F.col(a) - pad) / F.col("__size")), F.floor((F.col(b) + pad) / F.col("__size")))
    return df.withColumn("__cx", F.explode(span("x1", "x2"))).withColumn("__cy", F.explode(span("y1", "y2")))


def box_pairs(left: DataFrame, right: DataFrame, cell: float = 128.0, within: float = 0.0, left_prefix: str = "l_", right_prefix: str = "r_") -> DataFrame:
    """All pairs of boxes at a distance of at most ``within`` on both axes (0: closed intersection); columns are prefixed.

    Both sides need x1, y1, x2, y2. Callers add the exact predicate for anything but boxes that touch.
    """
    found = left.select(_level(cell, within).alias("l")).union(right.select(_level(cell, within).alias("l"))).distinct()
    levels = sorted(r[0] for r in found.collect())  # at most some forty
    named = lambda df, p: df.select(*[F.col(c).alias(c if c.startswith("__") else p + c) for c in df.columns])
    lp, rp = left_prefix, right_prefix
    a = named(_celled(left, "__own_l", levels, cell, within), lp)
    b = named(_celled(right, "__own_r", levels, cell, 0.0), rp)
    met = a.join(b, ["__level", "__size", "__cx", "__cy"]).where(F.col("__level") == F.greatest("__own_l", "__own_r"))
    near = lambda lo, hi: (F.col(lp + lo) - within <= F.col(rp + hi)) & (F.col(rp + lo) <= F.col(lp + hi) + within)
    corner = lambda lo: F.floor(F.greatest(F.col(lp + lo) - within, F.col(rp + lo)) / F.col("__size"))
    met = met.where(near("x1", "x2") & near("y1", "y2") & (corner("x1") == F.col("__cx")) & (corner("y1") == F.col("__cy")))
    return met.drop(*[c for c in met.columns if c.startswith("__")])


def overlap_area(lp: str = "l_", rp: str = "r_") -> Column:
    side = lambda lo, hi: F.greatest(F.least(F.col(lp + hi), F.col(rp + hi)) - F.greatest(F.col(lp + lo), F.col(rp + lo)), F.lit(0))
    return side("x1", "x2") * side("y1", "y2")


def distance_squared(lp: str = "l_", rp: str = "r_") -> Column:
    gap = lambda lo, hi: F.greatest(F.col(lp + lo) - F.col(rp + hi), F.col(rp + lo) - F.col(lp + hi), F.lit(0))
    return gap("x1", "x2") * gap("x1", "x2") + gap("y1", "y2") * gap("y1", "y2")


def share_edge_or_area(lp: str = "l_", rp: str = "r_") -> Column:
    """Boxes that overlap or share more than a corner."""
    side = lambda lo, hi: F.least(F.col(lp + hi), F.col(rp + hi)) - F.greatest(F.col(lp + lo), F.col(rp + lo))
    dx, dy = side("x1", "x2"), side("y1", "y2")
    return ((dx > 0) & (dy >= 0)) | ((dx >= 0) & (dy > 0))


def semi(left: DataFrame, right: DataFrame, key: str, **how) -> DataFrame:
    """Rows of ``left`` that touch some row of ``right``."""
    hit = box_pairs(left, right, **how).select(F.col("l_" + key).alias(key)).distinct()
    return left.join(hit, key, "left_semi")


def anti(left: DataFrame, right: DataFrame, key: str, within: float = 0.0, cell: float = 128.0) -> DataFrame:
    """Rows of ``left`` farther than ``within`` from every row of ``right`` (all of them, if it is empty)."""
    hit = box_pairs(left, right, cell, within).where(distance_squared() <= within * within).select(F.col("l_" + key).alias(key)).distinct()
    return left.join(hit, key, "left_anti")


def marked(left: DataFrame, right: DataFrame, key: str, out: str, **how) -> DataFrame:
    """Adds whether a row of ``left`` touches some row of ``right``."""
    hit = box_pairs(left, right, **how).select(F.col("l_" + key).alias(key)).distinct().withColumn(out, F.lit(True))
    return left.join(hit, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def first_match(left: DataFrame, right: DataFrame, key: str, right_key: str, out: str, **how) -> DataFrame:
    """Adds the least ``right_key`` that touches a row of ``left``, or null."""
    hit = box_pairs(left, right, **how).groupBy(F.col("l_" + key).alias(key)).agg(F.min("r_" + right_key).alias(out))
    return left.join(hit, key, "left")


def points_inside(points: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """Keys of points (x, y) strictly inside some box."""
    own = points.select(F.col(key), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    strict = (F.col("l_x1") > F.col("r_x1")) & (F.col("l_x1") < F.col("r_x2")) & (F.col("l_y1") > F.col("r_y1")) & (F.col("l_y1") < F.col("r_y2"))
    return box_pairs(own, boxes.select(*BOX)).where(strict).select(F.col("l_" + key).alias(key)).distinct()
