"""Spatial joins on polygons: boxes by the grid join, then the exact predicate on what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pvscan.functions import geo, kernels
from pvscan.operators import spatial
from pvscan.operators.graph import components


def with_boxes(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Adds the geometry in equal-area metres (shape) and its box x1, y1, x2, y2."""
    own = df.withColumn("shape", geo.projected(F.col(geom)))
    return own.withColumn("__b", geo.bbox(F.col("shape"))).select("*", *[F.col(f"__b.{c}").alias(c) for c in spatial.BOX]).drop("__b")


def _pairs(left: DataFrame, right: DataFrame, keys: tuple[str, str], cell: float, within: float = 0.0) -> DataFrame:
    a, b = (df.select(k, "shape", *spatial.BOX) for df, k in zip((left, right), keys, strict=True))
    return spatial.box_pairs(a, b, cell, within)


def intersecting(left: DataFrame, right: DataFrame, keys: tuple[str, str], cell: float = 128.0) -> DataFrame:
    """Pairs of keys (l_, r_) whose polygons share a point."""
    return _pairs(left, right, keys, cell).where(kernels.geom_intersects("l_shape", "r_shape")).select(f"l_{keys[0]}", f"r_{keys[1]}")


def overlapping(left: DataFrame, right: DataFrame, keys: tuple[str, str], cell: float = 128.0) -> DataFrame:
    """Pairs of keys with the area they share (part), where there is any."""
    return _pairs(left, right, keys, cell).withColumn("part", kernels.geom_overlap("l_shape", "r_shape")).where("part > 0").select(f"l_{keys[0]}", f"r_{keys[1]}", "part")


def near(left: DataFrame, right: DataFrame, keys: tuple[str, str], metres: float, cell: float = 128.0) -> DataFrame:
    """Pairs of keys at most so far apart."""
    return _pairs(left, right, keys, cell, metres).where(kernels.geom_distance("l_shape", "r_shape") <= metres).select(f"l_{keys[0]}", f"r_{keys[1]}")


def free_of(left: DataFrame, right: DataFrame, keys: tuple[str, str], metres: float) -> DataFrame:
    """Rows of ``left`` with nothing of ``right`` so near."""
    hit = near(left, right, keys, metres).select(F.col(f"l_{keys[0]}").alias(keys[0])).distinct()
    return left.join(hit, keys[0], "left_anti")


def clusters(df: DataFrame, key: str) -> DataFrame:
    """``key`` and root: shapes that overlap or share more than a point of their borders, directly or through others, have one root."""
    met = _pairs(df, df, (key, key), 128.0).where(F.col(f"l_{key}") < F.col(f"r_{key}")).where(kernels.geom_joined("l_shape", "r_shape"))
    linked = components(met.select(F.col(f"l_{key}").alias("a"), F.col(f"r_{key}").alias("b")))
    return df.select(key).join(linked.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("root", key).alias("root"))


def dissolved(df: DataFrame, group: str, order: str, any_of: list[str] = (), first: list[str] = ()) -> DataFrame:
    """One row of each group: its polygons together, area_m2 of their union, flags or-ed, other columns from the first member."""
    area = F.pandas_udf(lambda s: s.map(lambda polys: kernels.union_area(kernels.rings(polys))), "double")
    out = df.groupBy(group).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, "geom", "shape"))), lambda x: x["geom"])).alias("geom"), F.flatten(F.collect_list("shape")).alias("shape"), *[F.bool_or(F.coalesce(c, F.lit(False))).alias(c) for c in any_of], *[F.min_by(c, order).alias(c) for c in first])
    return out.withColumn("area_m2", area("shape"))
