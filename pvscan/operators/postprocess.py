"""The product: predicted solar on each building, what the map lacks, and how they compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pvscan.functions import geo
from pvscan.operators import polygons, spatial


def building_solar_stats(buildings: DataFrame, predicted: DataFrame, solar: DataFrame | None, min_coverage: float, key: str = "building_id") -> DataFrame:
    """Each building with area_m2, pred_solar_m2, mean_prob (of the overlapping parts, unweighted), coverage, has_solar and osm_has_solar.

    ``predicted`` has boxes and prob. Without predictions all have none; without solar (None) osm_has_solar is false.
    """
    met = spatial.box_pairs(buildings.select(key, *spatial.BOX), predicted).withColumn("part", spatial.overlap_area()).where("part > 0")
    by = met.groupBy(F.col(f"l_{key}").alias(key)).agg(F.sum("part").cast("double").alias("pred_solar_m2"), F.avg("r_prob").alias("mean_prob"))
    own = buildings.withColumn("area_m2", ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).cast("double")).join(by, key, "left").fillna(0.0, ["pred_solar_m2", "mean_prob"])
    own = own.withColumn("coverage", F.col("pred_solar_m2") / F.col("area_m2")).withColumn("has_solar", F.col("coverage") >= min_coverage)
    return own.withColumn("osm_has_solar", F.lit(False)) if solar is None else spatial.marked(own, solar, key, "osm_has_solar")


def shape_solar_stats(buildings: DataFrame, predicted: DataFrame, solar: DataFrame | None, min_coverage: float, key: str = "building_id", solar_key: str = "osm_id") -> DataFrame:
    """The same by shapes: ``buildings`` and ``solar`` have shape and its box; ``predicted`` has comp, prob and disjoint boxes, as many as a component needs.

    What a building shares with a component is the area of its shape inside the component's boxes; mean_prob is over components.
    Areas are those of the shapes' plane.
    """
    parts = spatial.box_pairs(buildings.select(key, "shape", *spatial.BOX), predicted.select("comp", "prob", *spatial.BOX))
    part = geo.clipped_area(F.col("l_shape"), *[F.col(f"r_{c}") for c in spatial.BOX])
    each = parts.withColumn("part", part).where("part > 0").groupBy(F.col(f"l_{key}").alias(key), "r_comp").agg(F.sum("part").alias("part"), F.first("r_prob").alias("prob"))
    by = each.groupBy(key).agg(F.sum("part").alias("pred_solar_m2"), F.avg("prob").alias("mean_prob"))
    own = buildings.withColumn("area_m2", geo.planar_area(F.col("shape"))).join(by, key, "left").fillna(0.0, ["pred_solar_m2", "mean_prob"])
    own = own.withColumn("coverage", F.coalesce(F.try_divide("pred_solar_m2", "area_m2"), F.lit(0.0))).withColumn("has_solar", F.col("coverage") >= min_coverage)
    if solar is None:
        return own.withColumn("osm_has_solar", F.lit(False))
    hit = polygons.intersecting(buildings, solar, (key, solar_key)).select(F.col(f"l_{key}").alias(key)).distinct().withColumn("osm_has_solar", F.lit(True))
    return own.join(hit, key, "left").withColumn("osm_has_solar", F.coalesce("osm_has_solar", F.lit(False)))


def missing_in_osm(stats: DataFrame, key: str = "building_id") -> DataFrame:
    """Buildings with solar that the map lacks, most confident first: coverage (1 at most) times mean probability."""
    own = stats.where("has_solar and not osm_has_solar")
    return own.withColumn("confidence", F.least(F.greatest("coverage", F.lit(0.0)), F.lit(1.0)) * F.col("mean_prob")).orderBy(F.desc("confidence"), key)


def confusion(stats: DataFrame) -> DataFrame:
    """tp, fp, fn, precision and recall (to three digits; null where nothing is counted)."""
    own = stats.agg(
        F.count_if(F.col("has_solar") & F.col("osm_has_solar")).alias("tp"),
        F.count_if(F.col("has_solar") & ~F.col("osm_has_solar")).alias("fp"),
        F.count_if(~F.col("has_solar") & F.col("osm_has_solar")).alias("fn"),
    )
    share = lambda other: F.round(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col(other)), 3)
    return own.withColumn("precision", share("fp")).withColumn("recall", share("fn"))
