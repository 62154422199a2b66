"""Label curation: elements, rooftop labels from solar polygons and buildings, source dedupe."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType

from pvscan.operators import spatial
from pvscan.operators.graph import components
from pvscan.scratch import written

#: Location tags in order of precedence, and the values that mean a roof (fixed values).
LOCATION_TAGS = ("location", "generator:place", "generator:location")
ROOF_VALUES = ("roof", "rooftop")
ELEMENT_TYPES = {"w": "way", "n": "node", "r": "relation"}


def parse_record_id(record: Column) -> tuple[Column, Column]:
    """``w123@5`` as (way, 123). Without a number both are null; an unknown letter leaves only the type null."""
    head = F.split(record, "@").getItem(0)
    digits = F.regexp_extract(head, r"^.(-?\d+)$", 1)
    ident = F.when(digits != "", digits.cast("bigint"))
    kind = reduce(lambda c, kv: F.when(F.substring(head, 1, 1) == kv[0], kv[1]).otherwise(c), ELEMENT_TYPES.items(), F.lit(None).cast("string"))
    return F.when(ident.isNotNull(), kind), ident


def first_filled_tag(tags: Column) -> Column:
    """The first location tag that is not empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(tags, F.lit(k)), F.lit("")) for k in LOCATION_TAGS])


def first_present_tag(tags: Column) -> Column:
    """The first location tag that is there, empty or not."""
    return F.coalesce(*[F.try_element_at(tags, F.lit(k)) for k in LOCATION_TAGS])


def dedupe_keyed(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row of each key (null keys are equal): the first in the given order."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__k = 1").drop("__k")


def clusters(boxes: DataFrame, key: str) -> DataFrame:
    """``key`` and root: boxes that overlap or share an edge, directly or through others, have one root."""
    met = spatial.box_pairs(boxes, boxes).where((F.col(f"l_{key}") < F.col(f"r_{key}")) & spatial.share_edge_or_area())
    linked = components(met.select(F.col(f"l_{key}").alias("a"), F.col(f"r_{key}").alias("b")))
    return boxes.select(key).join(linked.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("root", key).alias("root"))


def label_groups(solar: DataFrame, buildings: DataFrame, key: str = "osm_id", building: str = "building_id") -> DataFrame:
    """``solar`` with building (the least that it touches, or null) and group: ``b<building>``, else ``c<cluster>``."""
    own = spatial.first_match(solar, buildings, key, building, "building")
    loose = clusters(own.where("building is null").select(key, *spatial.BOX), key)
    own = own.join(loose, key, "left")
    return own.withColumn("group", F.when(F.col("building").isNotNull(), F.concat(F.lit("b"), F.col("building"))).otherwise(F.concat(F.lit("c"), F.col("root")))).drop("root")


def union_area(boxes: np.ndarray) -> float:
    """Area of the union of boxes (rows x1, y1, x2, y2): a sweep along x keeps how many boxes cover each interval of y."""
    boxes = boxes[(boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])]
    if not len(boxes):
        return 0.0
    ys = np.unique(boxes[:, [1, 3]])
    heights, covered = np.diff(ys), np.zeros(len(ys) - 1, np.int64)
    lo, hi = np.searchsorted(ys, boxes[:, 1]), np.searchsorted(ys, boxes[:, 3])
    x = np.concatenate([boxes[:, 0], boxes[:, 2]])
    order = np.argsort(x, kind="stable")
    total, last = 0.0, x[order[0]]
    for k in order.tolist():
        if x[k] > last:
            total += (x[k] - last) * heights[covered > 0].sum()
            last = x[k]
        own = k % len(boxes)
        covered[lo[own] : hi[own]] += 1 if k < len(boxes) else -1
    return float(total)


@F.pandas_udf(DoubleType())
def _union_area(boxes: pd.Series) -> pd.Series:
    return boxes.map(lambda own: union_area(np.array([(b["x1"], b["y1"], b["x2"], b["y2"]) for b in own], float)))


def build_labels(solar: DataFrame, buildings: DataFrame, min_area: float, rule: str = "intersect_or_roof_tag", key: str = "osm_id") -> DataFrame:
    """Solar boxes grouped by building or cluster, dissolved, then thresholded by area and by the rooftop rule.

    ``solar`` needs a boolean ``roof`` (its location tag says so; null is false). Returns group, osm_id (of the first member),
    has_roof_tag, on_building, n and area_m2 of the union.
    """
    if rule not in ("roof_tag_only", "intersect_only", "intersect_or_roof_tag"):
        raise ValueError(f"unknown rooftop rule {rule!r}")
    own = label_groups(solar, buildings, key)
    merged = own.groupBy("group").agg(F.min(key).alias("osm_id"), F.bool_or(F.coalesce("roof", F.lit(False))).alias("has_roof_tag"), F.min(F.col("building").isNotNull()).alias("on_building"), F.count("*").alias("n"), F.collect_list(F.struct(*spatial.BOX)).alias("boxes"))
    merged = merged.withColumn("area_m2", _union_area("boxes")).drop("boxes").where(F.col("area_m2") >= min_area)
    if rule == "roof_tag_only":
        return merged.where("has_roof_tag")
    return merged.where("on_building") if rule == "intersect_only" else merged.where("on_building or has_roof_tag")


def dedupe_sources(sources: list[DataFrame], key: str = "id") -> DataFrame:
    """Buildings of several sources in order of priority: a later one goes if its centre is strictly inside a kept one.

    A source is not deduplicated within itself. Each needs key, x1, y1, x2, y2.
    """
    kept = sources[0]
    for later in sources[1:]:
        centre = later.select(key, ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
        inside = spatial.points_inside(centre, kept.select(*spatial.BOX), key)
        kept = kept.unionByName(later.join(inside, key, "left_anti"), allowMissingColumns=True)
    return kept


def with_building_id(buildings: DataFrame, order: list[str]) -> DataFrame:
    """Numbers buildings from 0 in a total order: counts of ranges are added, so no task sorts all rows."""
    spark = buildings.sparkSession
    dealt = buildings.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    placed = written(dealt.withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = placed.groupBy("__part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("__start"))  # a row for each partition
    at = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return placed.join(F.broadcast(starts), "__part").withColumn("building_id", (F.col("__start") + at - 1).cast("bigint")).drop("__part", "__start")


def solar_free(buildings: DataFrame, solar: DataFrame, buffer_m: float, key: str = "building_id") -> DataFrame:
    """Buildings farther than ``buffer_m`` from all solar; all of them if there is none."""
    return spatial.anti(buildings, solar, key, within=buffer_m)


def points_of(later: DataFrame, kept: DataFrame, key: str = "id") -> DataFrame:
    """Keys of ``later`` whose shape's centroid is strictly inside a kept shape's box and shape."""
    from pvscan.functions import geo

    at = later.select(key, geo.centroid(F.col("shape")).alias("p")).select(key, F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    own = at.select(key, "x", "y", F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    met = spatial.box_pairs(own, kept.select("shape", *spatial.BOX))
    return met.where(_inside("l_x", "l_y", "r_shape")).select(F.col(f"l_{key}").alias(key)).distinct()


@F.pandas_udf(BooleanType())
def _inside(x: pd.Series, y: pd.Series, shape: pd.Series) -> pd.Series:
    from pvscan.functions import kernels

    return pd.Series([any(kernels.points_in_polygon(np.array([[a, b]]), p)[0] for p in kernels.rings(s)) for a, b, s in zip(x, y, shape, strict=True)], dtype=bool)
