"""Vector sources: release tables of features, map elements from cached responses, boundaries from GeoJSON."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvscan.functions import geo
from pvscan.operators.labels import dedupe_keyed, first_filled_tag, first_present_tag, parse_record_id

Bounds = Sequence[float]
#: Padding of a solar polygon's box in degrees, and boxes in a query (fixed values).
PAD, BATCH = 0.001, 40
#: Retries of a remote read and pause between them, for S3A.
READ_SETTINGS = {"fs.s3a.connection.timeout": "300000", "fs.s3a.attempts.maximum": "8", "fs.s3a.retry.interval": "2s", "fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}


def theme_path(base: str, release: str, theme: str, kind: str) -> str:
    return f"{base.rstrip('/')}/release/{release}/theme={theme}/type={kind}"


def read_theme(spark: SparkSession, base: str, release: str, theme: str, kind: str) -> DataFrame:
    return spark.read.option("basePath", f"{base.rstrip('/')}/release/{release}").parquet(theme_path(base, release, theme, kind))


def solar_generators(infrastructure: DataFrame, bounds: Bounds, polygons_only: bool = True) -> DataFrame:
    """Solar generators and plants in the bounds: osm_type, osm_id, tags, location_tag, geom; one row of each id.

    Needs id, bbox, subtype, sources (array of struct with record_id), source_tags (map) and geom.
    """
    tag = lambda k: F.try_element_at("source_tags", F.lit(k))
    own = infrastructure.where(geo.bbox_overlaps("bbox", *bounds) & (F.col("subtype") == "power")).where((tag("generator:source") == "solar") | (tag("plant:source") == "solar"))
    if polygons_only:
        own = own.where(F.size("geom") > 0)
    kind, ident = parse_record_id(F.try_element_at("sources", F.lit(1))["record_id"])
    own = own.select("id", kind.alias("osm_type"), ident.alias("osm_id"), F.col("source_tags").alias("tags"), first_present_tag(F.col("source_tags")).alias("location_tag"), "geom")
    return dedupe_keyed(own, ["osm_type", "osm_id"], ["id"]).drop("id")


def buildings_in_bbox(buildings: DataFrame, bounds: Bounds, min_area_m2: float | None = None, source: str = "overture") -> DataFrame:
    """Buildings that overlap the bounds: id (of the geometry's hash where the source has none), source, geom."""
    own = buildings.where(geo.bbox_overlaps("bbox", *bounds))
    ident = F.col("id").cast("string") if "id" in buildings.columns else F.concat(F.lit(f"{source}_"), F.substring(F.sha2(F.to_json("geom"), 256), 1, 16))
    own = own.select(ident.alias("id"), F.lit(source).alias("source"), "geom")
    return own if min_area_m2 is None else geo.with_min_area(own, min_area_m2)


def _ql_box(b: Bounds) -> str:
    """The query language wants south, west, north, east."""
    return "({1},{0},{3},{2})".format(*b)


def _ql(timeout_s: int, filters: list[str], boxes: list[Bounds]) -> str:
    lines = [f"  {kind}{f}{_ql_box(b)};" for b in boxes for f in filters for kind in ("way", "relation")]
    return "\n".join([f"[out:json][timeout:{timeout_s}];", "(", *lines, ");", "out body geom;"])


def solar_query(bounds: Bounds, timeout_s: int) -> str:
    return _ql(timeout_s, ['["power"="generator"]["generator:source"="solar"]', '["power"="plant"]["plant:source"="solar"]'], [bounds])


def buildings_query(boxes: list[Bounds], timeout_s: int) -> str:
    return _ql(timeout_s, ['["building"]'], boxes)


def cache_name(query: str) -> str:
    """File of a query's cached response."""
    return hashlib.sha256(query.encode()).hexdigest()[:24] + ".json"


_POINTS = "array<struct<lat:double,lon:double>>"
RESPONSE = f"elements array<struct<type:string,id:bigint,tags:map<string,string>,geometry:{_POINTS},members:array<struct<type:string,ref:bigint,role:string,geometry:{_POINTS}>>>>"


def read_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Cached responses as one row for each element. (There is no client: the cache is filled elsewhere.)"""
    return spark.read.schema(RESPONSE).option("multiLine", True).json(folder).select(F.explode("elements").alias("e")).select("e.*")


def elements_to_polygons(elements: DataFrame) -> DataFrame:
    """Closed ways and relations as osm_type, osm_id, tags (JSON, sorted), location_tag, geom; one row of each id.

    A relation's members that are not ``inner`` are shells; inner rings are holes of the first shell.
    """
    own_ring = F.filter(F.array(geo.ring(F.col("geometry"))), lambda r: r.isNotNull())
    outer = F.filter(F.transform(F.filter("members", lambda m: m["role"] != "inner"), lambda m: geo.ring(m["geometry"])), lambda r: r.isNotNull())
    inner = F.filter(F.transform(F.filter("members", lambda m: m["role"] == "inner"), lambda m: geo.ring(m["geometry"])), lambda r: r.isNotNull())
    relation = F.transform(F.coalesce(outer, F.array()), lambda r, i: F.when(i == 0, F.concat(F.array(r), F.coalesce(inner, F.array()))).otherwise(F.array(r)))
    way = F.when(F.size(own_ring) > 0, F.array(own_ring)).otherwise(F.array().cast(geo.GEOMETRY))
    geom = F.when(F.col("type") == "way", way).when(F.col("type") == "relation", relation.cast(geo.GEOMETRY))
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    rows = elements.where(F.col("type").isin("way", "relation")).withColumn("geom", geom).where(F.size("geom") > 0)
    sorted_tags = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(tags))))
    rows = rows.select(F.col("type").alias("osm_type"), F.col("id").alias("osm_id"), sorted_tags.alias("tags"), first_filled_tag(tags).alias("location_tag"), "geom")
    return dedupe_keyed(rows, ["osm_type", "osm_id"], [F.length(F.to_json("geom")), F.to_json("geom")])


def padded_boxes(solar: DataFrame) -> DataFrame:
    """Each solar polygon's box grown by PAD degrees: west, south, east, north."""
    b = geo.bbox(F.col("geom"))
    return solar.select((b["x1"] - PAD).alias("west"), (b["y1"] - PAD).alias("south"), (b["x2"] + PAD).alias("east"), (b["y2"] + PAD).alias("north"))


def clip_to(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Rows whose geometry touches a box of degrees; geometries stay whole."""
    from pvscan.functions.kernels import geom_intersects

    w, s, e, n = bounds
    b = geo.bbox(F.col("geom"))
    near = (b["x1"] <= e) & (b["x2"] >= w) & (b["y1"] <= n) & (b["y2"] >= s)
    return df.where(near).where(geom_intersects("geom", geo.box(*[F.lit(float(v)) for v in (w, s, e, n)])))


def clip_to_boundary(df: DataFrame, boundary_: DataFrame) -> DataFrame:
    """Rows whose geometry touches the boundary's shape; geometries stay whole.

    The boundary's polygons are one region's: they are collected and broadcast, and rows outside of their box never reach them.
    """
    from pvscan.functions import kernels

    rows = boundary_.select("geom").collect()
    geometry = [p for row in rows for p in kernels.rings(row.geom)]
    if not geometry:
        return df.limit(0)
    shared = df.sparkSession.sparkContext.broadcast(kernels.Prepared(geometry))
    shells = [p[0] for p in geometry]
    w, s = (float(min(r[:, i].min() for r in shells)) for i in (0, 1))
    e, n = (float(max(r[:, i].max() for r in shells)) for i in (0, 1))

    @F.pandas_udf("boolean")
    def touches(geom):
        return geom.map(lambda g: shared.value.intersects(kernels.rings(g)))

    b = geo.bbox(F.col("geom"))
    near = (b["x1"] <= e) & (b["x2"] >= w) & (b["y1"] <= n) & (b["y2"] >= s)
    return df.where(near).where(touches("geom"))


def dissolve_all(df: DataFrame, geom: str = "geom") -> DataFrame:
    """All geometries as one row: their polygons together, in a fixed order. No rows: one row without polygons."""
    return df.agg(F.flatten(F.array_sort(F.collect_list(geom))).alias(geom))


def in_degrees(df: DataFrame, geom: str = "geom") -> DataFrame:
    """``df``, if its geometries can be degrees (the only stored reference system); ValueError names how many can't."""
    b = geo.bbox(F.col(geom))
    bad = df.where((b["x1"] < -180) | (b["x2"] > 180) | (b["y1"] < -90) | (b["y2"] > 90)).count()
    if bad:
        raise ValueError(f"{bad} geometries are not in degrees")
    return df


def cells_of(boundary_: DataFrame, bounds: Bounds, step: float) -> DataFrame:
    """Cells of the grid over the bounds that touch the boundary's shape: ix, iy, west, south, east, north."""
    cells = geo.bbox_grid(boundary_.sparkSession, bounds, step)
    own = cells.withColumn("geom", geo.box(*[F.col(c) for c in ("west", "south", "east", "north")]))
    return clip_to_boundary(own, boundary_).drop("geom")


def boundary(spark: SparkSession, geojson: str, admin_name: str | None = None) -> DataFrame:
    """Boundaries (name, geom) from a GeoJSON file; a name is compared without regard to case, and one that is missing raises KeyError with those there are."""
    shape = "features array<struct<properties:struct<shapeName:string>,geometry:struct<type:string,coordinates:string>>>"
    own = spark.read.schema(shape).option("multiLine", True).json(geojson).select(F.explode("features").alias("f"))
    ring = "array<array<array<double>>>"
    polygons = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json("f.geometry.coordinates", ring))).otherwise(F.from_json("f.geometry.coordinates", f"array<{ring}>"))
    to_points = lambda polys: F.transform(polys, lambda poly: F.transform(poly, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))
    out = own.select(F.col("f.properties.shapeName").alias("name"), to_points(polygons).alias("geom"))
    if admin_name is None:
        return out
    found = out.where(F.lower("name") == admin_name.lower())
    if found.isEmpty():
        names = sorted(r[0] for r in out.select("name").where("name is not null").distinct().collect())
        raise KeyError(f"no boundary is named {admin_name!r}; there are {', '.join(names)}")
    return found


def bbox_boundary(spark: SparkSession, bounds: Bounds, name: str = "bbox") -> DataFrame:
    return spark.range(1).select(F.lit(name).alias("name"), geo.box(*[F.lit(float(b)) for b in bounds]).alias("geom"))
