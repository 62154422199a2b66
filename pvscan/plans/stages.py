"""Stages of a region: each reads tables, writes tables, and is skipped while its result is fresh.

There is no network and no deep-learning library here: sources are tables and cached responses below
``inputs``, and pixels are scored by a logistic model over bands unless a scorer is given.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pvscan.artifacts import Store, build_map, is_fresh, packed, read_json, register_composite, replace_tiles, write_geojson, write_json, write_meta
from pvscan.config import Config
from pvscan.functions import geo, kernels
from pvscan.operators import curation, labels, polygons, postprocess, raster, spatial
from pvscan.scratch import written
from pvscan.sources import vectors

log = logging.getLogger("pvscan")
Scorer = Callable[[np.ndarray], np.ndarray]


class Region:
    """A configured region with its store and its inputs."""

    def __init__(self, spark: SparkSession, cfg: Config, inputs: str | Path) -> None:
        self.spark, self.cfg, self.inputs, self.store = spark, cfg, Path(inputs), Store(Path(cfg.data_dir) / cfg.region)

    def read(self, *parts: str) -> DataFrame:
        return self.spark.read.parquet(str(self.store.table(*parts)))

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(str(self.inputs / f"{name}.parquet"))

    def make(self, parts: tuple[str, ...], sections: tuple[str, ...], inputs: list[Path], build: Callable[[], DataFrame]) -> Path:
        """Writes a table unless it is fresh."""
        path, settings = self.store.table(*parts), self.cfg.section(*sections)
        if is_fresh(path, settings, inputs):
            log.info("%s is fresh", path)
            return path
        path.parent.mkdir(parents=True, exist_ok=True)
        build().write.mode("overwrite").parquet(str(path))
        write_meta(path, settings, inputs)
        return path

    def bounds(self) -> tuple[float, ...]:
        box = self.read("aoi", "boundary").select(geo.bbox(F.col("geom")).alias("b")).agg(F.min("b.x1"), F.min("b.y1"), F.max("b.x2"), F.max("b.y2")).first()
        return tuple(box)


def aoi(r: Region) -> None:
    """Boundary and worklist of tiles; the tile whitelist is part of what makes it stale."""
    a = r.cfg.aoi
    if a.source == "overpass_admin":
        raise NotImplementedError("aoi.source overpass_admin has no source here")
    make = (lambda: vectors.bbox_boundary(r.spark, a.bbox, r.cfg.region)) if a.source == "bbox" else (lambda: vectors.boundary(r.spark, str(r.inputs / "boundaries.geojson"), a.admin_name))
    r.make(("aoi", "boundary"), ("aoi",), [], make)
    geometry = [p for row in r.read("aoi", "boundary").collect() for p in kernels.rings(row.geom)]
    tiles = kernels.tiles_for(geometry)
    wanted = r.cfg.imagery.tiles
    write_json([t for t in tiles if wanted is None or t in wanted], r.store.root / "aoi" / "tiles.json")


def _solar(r: Region) -> DataFrame:
    if r.cfg.osm.source == "overture":
        found = vectors.solar_generators(r.source("infrastructure"), r.bounds())
        return found.withColumn("tags", F.to_json("tags"))
    return vectors.elements_to_polygons(vectors.read_responses(r.spark, str(r.inputs / "overpass_solar")))


def make_labels(r: Region) -> None:
    """Solar polygons, the buildings near them, and the curated labels."""
    o, box = r.cfg.osm, r.bounds
    boundary = r.store.table("aoi", "boundary")
    r.make(("osm", "solar"), ("aoi", "osm", "overture"), [boundary], lambda: vectors.clip_to_boundary(_solar(r), r.read("aoi", "boundary")))
    solar = polygons.with_boxes(r.read("osm", "solar").withColumn("roof", F.col("location_tag").isin(*labels.ROOF_VALUES)))

    def buildings() -> DataFrame:
        own = vectors.buildings_in_bbox(r.source("buildings"), box()) if o.source == "overture" else vectors.elements_to_polygons(vectors.read_responses(r.spark, str(r.inputs / "overpass_buildings"))).select(F.concat("osm_type", F.col("osm_id")).alias("id"), F.lit("overpass").alias("source"), "geom")
        met = polygons.intersecting(polygons.with_boxes(own), solar, ("id", "osm_id")).select(F.col("l_id").alias("id")).distinct()
        return own.join(met, "id", "left_semi")

    r.make(("osm", "buildings"), ("aoi", "osm", "overture"), [r.store.table("osm", "solar")], buildings)

    def curated() -> DataFrame:
        near = polygons.with_boxes(r.read("osm", "buildings"))
        first = polygons.intersecting(solar, near, ("osm_id", "id")).groupBy(F.col("l_osm_id").alias("osm_id")).agg(F.min("r_id").alias("building"))
        own = solar.join(first, "osm_id", "left")
        loose = polygons.clusters(own.where("building is null"), "osm_id")
        own = own.join(loose, "osm_id", "left").withColumn("group", F.coalesce(F.concat(F.lit("b"), "building"), F.concat(F.lit("c"), "root"))).withColumn("on_building", F.col("building").isNotNull())
        out = polygons.dissolved(own, "group", "osm_id", ["roof", "on_building"], ["osm_type", "osm_id", "location_tag", "tags"])
        out = out.where(F.col("area_m2") >= o.solar_area_min_m2).withColumnRenamed("roof", "has_roof_tag").drop("shape")
        keep = {"roof_tag_only": "has_roof_tag", "intersect_only": "on_building"}.get(o.rooftop_rule, "has_roof_tag or on_building")
        return out.where(keep)

    r.make(("osm", "labels"), ("osm",), [r.store.table("osm", "solar"), r.store.table("osm", "buildings")], curated)


def _part(base: Path, tile: str, k: int) -> Path:
    return base / f"tile={tile}" / f"range_idx={k}"


def composite(r: Region, only_tiles: list[str] | None = None) -> None:
    """Cloud-free composites of all tiles and date ranges that are not fresh, in one query over scenes and observations.

    A tile and range without observations is named in an error at the end. One whose observations are all clouded is left out
    with a warning if its source are scenes, and is an error if they are mosaics.
    """
    i, base = r.cfg.imagery, r.store.root / "composites" / "data"
    settings, inputs = r.cfg.section("imagery"), [r.inputs / "scenes.parquet"]
    tiles = [t for t in json.loads((r.store.root / "aoi" / "tiles.json").read_text()) if only_tiles is None or t in only_tiles]
    every = [(t, k) for t in tiles for k in range(len(i.date_ranges))]
    todo = [x for x in every if not is_fresh(_part(base, *x), settings, inputs)]
    seen = set()
    if todo:
        obs, mosaic = _observations(r, todo)
        seen = {(x.tile, x.range_idx) for x in obs.select("tile", "range_idx").distinct().collect()}  # a row for each composite
        wide = _composites(obs, i, mosaic)
        wide.write.partitionBy("tile", "range_idx").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(str(base))
    failed = []
    for tile, k in every:
        path, (start, end) = _part(base, tile, k), i.date_ranges[k]
        if path.exists() and ((tile, k) not in todo or (tile, k) in seen):
            if (tile, k) in todo:
                write_meta(path, settings, inputs)
            register_composite(r.store.root / "composites" / "catalogue.json", tile, k, bands=list(i.bands), start=start, end=end, href=str(path))
        elif (tile, k) in seen and i.stac_source not in _MOSAICS:
            log.warning("all observations of %s, range %d, are clouded", tile, k)
        else:
            failed.append(f"{tile} range {k}")
    if failed:
        raise RuntimeError(f"{len(failed)} composites failed: {', '.join(failed)}")


_MOSAICS = ("cdse_mosaics", "earthgenome")


def _observations(r: Region, todo: list[tuple[str, int]]) -> tuple[DataFrame, bool]:
    """Observations of the chosen scenes with their range and the order of their scene."""
    i = r.cfg.imagery
    mosaic = i.stac_source in _MOSAICS
    scenes, chosen = r.source("scenes").where(F.col("tile").isin(sorted({t for t, _ in todo}))), None
    for k in sorted({k for _, k in todo}):
        own = scenes.where(F.col("tile").isin([t for t, j in todo if j == k]))
        own = raster.clearest_scenes(own, i.collection, float("inf") if mosaic else i.max_cloud_pct, i.max_scenes, *i.date_ranges[k])
        own = own.select("item_id", F.lit(k).alias("range_idx"), F.to_date("ts").alias("day"), F.struct("cloud", "ts", "item_id").alias("scene"))
        chosen = own if chosen is None else chosen.unionByName(own)
    obs = r.source("observations").where(F.col("tile").isin(sorted({t for t, _ in todo})) & F.col("band").isin(*i.bands))
    return obs.join(F.broadcast(chosen), "item_id"), mosaic  # at most max_scenes rows a tile and range


def _composites(obs: DataFrame, i, mosaic: bool) -> DataFrame:
    """tile, range_idx, r, c and bands. Of a solar day the first valid value counts, in the order of scenes."""
    keys = ["tile", "range_idx", "r", "c", "band"]
    valid = obs if mosaic else obs.where(F.col("scl").isin(*raster.CLEAR))
    daily = raster.daily_mosaic(valid, keys, ["scene"])
    out = raster.composite(daily, keys, i.composite_method, None)
    wide = out.groupBy("tile", "range_idx", "r", "c").pivot("band", list(i.bands)).agg(F.first("value")).fillna(0, list(i.bands))
    return wide.where(F.greatest(*[F.col(b) for b in i.bands], F.lit(0)) > 0)  # pixels without data are absent


def _rasters(r: Region, only_tiles: list[str] | None = None) -> DataFrame:
    """Pixels of the registered composites: tile, range_idx, r, c, bands."""
    items = [i for i in read_json(r.store.root / "composites" / "catalogue.json").values() if only_tiles is None or i["tile"] in only_tiles]
    base = r.store.root / "composites" / "data"
    paths = [str(_part(base, i["tile"], i["range_idx"])) for i in items if _part(base, i["tile"], i["range_idx"]).exists()]
    if not paths:
        raise FileNotFoundError("no composites; run composite first")
    return r.spark.read.option("basePath", str(base)).parquet(*paths).withColumn("tile", F.col("tile").cast("string"))


def buildings(r: Region) -> None:
    """Large buildings of all sources, earlier sources first, with area_m2 and building_id."""
    b = r.cfg.buildings

    def build() -> DataFrame:
        files = {"overture": "buildings", "vida_open_buildings": "vida_buildings"}
        own = [polygons.with_boxes(vectors.clip_to_boundary(vectors.buildings_in_bbox(r.source(files[s]), r.bounds(), source=s), r.read("aoi", "boundary"))) for s in b.sources]
        kept = own[0]
        for later in own[1:]:
            inside = labels.points_of(later, kept)
            kept = kept.unionByName(later.join(inside, "id", "left_anti"))
        return labels.with_building_id(geo.with_min_area(kept, b.areas.fetched), ["source", "id"]).drop("shape")

    r.make(("buildings", "buildings"), ("aoi", "buildings", "overture"), [r.store.table("aoi", "boundary")], build)


def chips(r: Region, only_tiles: list[str] | None = None) -> None:
    """Chips around labels and solar-free buildings: their index and their pixels with masks, cut from the first range's composites.

    A chip goes if half of it or more has no data, and a positive one if no label pixel is in it. Splits go over the whole index, so no block is
    ever divided. With ``only_tiles``, chips of other tiles stay as they are.
    """
    c, s, patch = r.cfg.chips, r.cfg.split, r.cfg.model.patch_size
    side, bands = r.cfg.imagery.target_resolution_m, list(r.cfg.imagery.bands)
    index_at, pixels_at = r.store.table("chips", "index"), r.store.table("chips", "pixels")
    inputs = [r.store.table("osm", "labels"), r.store.table("buildings", "buildings"), r.store.root / "composites" / "catalogue.json"]
    sections = ("chips", "split", "model")
    if only_tiles is None and is_fresh(index_at, r.cfg.section(*sections), inputs):
        log.info("%s is fresh", index_at)
        return
    positive = polygons.with_boxes(r.read("osm", "labels"))
    large = polygons.with_boxes(r.read("buildings", "buildings").where(F.col("area_m2") >= r.cfg.buildings.building_area_min_m2).select("building_id", "geom"))
    free = polygons.free_of(large, polygons.with_boxes(r.read("osm", "solar")), ("building_id", "osm_id"), c.solar_free_buffer_m)
    target = round(positive.count() * c.pos_per_label * c.neg_ratio)
    negative = curation.sample_negatives(free, target, "building_id", s.seed).select(F.concat(F.lit("n"), "building_id").alias("fid"), F.lit("neg").alias("kind"), *spatial.BOX)
    own = positive.select(F.col("group").alias("fid"), F.lit("pos").alias("kind"), *spatial.BOX).unionByName(negative)
    own = own.withColumn("k", F.explode(F.sequence(F.lit(0), F.when(F.col("kind") == "pos", c.pos_per_label).otherwise(1) - 1)))
    own = own.withColumn("name", F.concat_ws("_", "kind", "fid", "k"))
    index = curation.assign_splits(own, (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2, s.block_size_km, s.ratios.train, s.ratios.val, s.seed, "shuffled")

    pixels = _rasters(r, only_tiles).where("range_idx = 0").drop("range_idx")
    tiles = F.broadcast(r.source("tiles").join(pixels.groupBy("tile").agg(F.max("r").alias("last_r"), F.max("c").alias("last_c")), "tile"))  # a row for each tile
    x, y = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    at_r, at_c = (F.col("y") - y) / side, (x - F.col("x")) / side
    placed = index.join(tiles, (at_r >= 0) & (at_c >= 0) & (at_r < F.col("last_r") + 1) & (at_c < F.col("last_c") + 1))
    first = F.row_number().over(Window.partitionBy("name").orderBy("tile"))  # where tiles overlap
    placed = placed.withColumn("n", first).where("n = 1")
    row, col = curation.jittered_corner(at_r, at_c, patch, F.col("name"), s.seed)
    placed = placed.select("name", "fid", "kind", "k", "block", "split", "tile", row.alias("row"), col.alias("col"), *spatial.BOX)
    marked = raster.labelled(pixels, _in_tiles(positive.select("shape", *spatial.BOX), tiles), ["tile"], side)
    cut = raster.cut_windows(placed.select("name", "tile", "row", "col"), marked, ["tile"], patch)
    cut = written(cut.select("name", F.col("k").alias("at"), *bands, "label"), "cut")
    sums = cut.groupBy("name").agg((1 - F.count("*") / F.lit(float(patch * patch))).alias("nodata"), F.sum("label").alias("label_pixels"))
    kept = placed.join(sums, "name").where((F.col("nodata") <= _MOST_NODATA) & ((F.col("kind") == "neg") | (F.col("label_pixels") > 0)))
    if only_tiles is not None and index_at.exists():
        old = r.read("chips", "index")
        kept, stays = replace_tiles(old.drop("cleaned_out", "share"), kept), old.where(~F.col("tile").isin(only_tiles)).select("name")
        cut = cut.unionByName(r.read("chips", "pixels").join(stays, "name", "left_semi"))
    kept = written(kept, "index")
    written(cut.join(kept.select("name"), "name", "left_semi"), "pixels").write.mode("overwrite").parquet(str(pixels_at))
    kept.write.mode("overwrite").parquet(str(index_at))
    write_meta(index_at, r.cfg.section(*sections), inputs)


#: How much of a chip, and of a window to be scored, may lack data.
_MOST_NODATA, _MOST_NODATA_SCORED = 0.5, 0.95


def _in_tiles(shapes: DataFrame, tiles: DataFrame) -> DataFrame:
    """Shapes in the metres of each tile that their box touches: x from its left, y up from its upper border."""
    box = [F.col(c) for c in spatial.BOX]
    side = lambda p: F.struct((p["x"] - F.col("x")).alias("x"), (p["y"] - F.col("y")).alias("y"))
    met = shapes.join(tiles.select("tile", "x", "y"), (box[2] >= F.col("x")) & (box[1] <= F.col("y")))
    moved = F.transform("shape", lambda poly: F.transform(poly, lambda ring: F.transform(ring, side)))
    return met.select("tile", moved.alias("shape"), (box[0] - F.col("x")).alias("x1"), (box[1] - F.col("y")).alias("y1"), (box[2] - F.col("x")).alias("x2"), (box[3] - F.col("y")).alias("y2"))


def pack_chips(r: Region) -> None:
    """One row for each chip, numbered in order of name (h5_row), with its pixels: places, an array of bands for each, and the mask."""
    bands = list(r.cfg.imagery.bands)

    r.make(("chips", "packed"), ("chips",), [r.store.table("chips", "index")], lambda: payload(r.read("chips", "index"), r.read("chips", "pixels"), bands))


def payload(index: DataFrame, pixels: DataFrame, bands: list[str]) -> DataFrame:
    """``index`` with h5_row and the chip's pixels (name, at, bands, label) in order of place."""
    own = F.struct("at", F.array(*[F.col(b).cast("int") for b in bands]).alias("bands"), F.col("label").cast("int").alias("label"))
    return packed(index, ["name"]).join(pixels.groupBy("name").agg(F.array_sort(F.collect_list(own)).alias("pixels")), "name")


def unpacked(table: DataFrame, rows: list[int], bands: list[str]) -> DataFrame:
    """Pixels of the packed chips of the given row numbers: h5_row, name, at, bands, label. Rows are chosen in the scan."""
    own = table.where(F.col("h5_row").isin(rows)).select("h5_row", "name", F.explode("pixels").alias("p"))
    return own.select("h5_row", "name", "p.at", *[F.col("p.bands")[k].alias(b) for k, b in enumerate(bands)], "p.label")


def _pixels(r: Region) -> DataFrame:
    return r.read("chips", "pixels").withColumn("label", F.col("label").cast("double"))


def train(r: Region, run_id: str | None = None) -> str:
    """Fits the pixel model (logistic regression over bands) on the train split; returns the run id.

    Of a few strengths of regularisation the one with the best validation loss is kept; without validation chips, the first.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler

    run_id = run_id or r.cfg.run_id()
    pool = curation.chip_pool({r.cfg.region: r.read("chips", "index")}).select("name", "split", "region")
    own = VectorAssembler(inputCols=list(r.cfg.imagery.bands), outputCol="features").transform(_pixels(r).join(pool, "name"))
    val, best = own.where("split = 'val'"), None
    loss = MulticlassClassificationEvaluator(metricName="logLoss")
    checked = not val.isEmpty()
    for strength in (0.0, 0.01, 0.1) if checked else (0.0,):
        model = LogisticRegression(maxIter=r.cfg.model.max_epochs, labelCol="label", regParam=strength).fit(own.where("split = 'train'"))
        at = loss.evaluate(model.transform(val)) if checked else 0.0
        if best is None or at < best[0]:
            best = (at, strength, model)
        else:
            break  # it only gets worse
    model = best[2]
    held = curation.split_of(own, "test", r.cfg.region)
    right = model.transform(held).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).first()["a"]
    write_json({"weights": [float(w) for w in model.coefficients], "bias": float(model.intercept), "bands": list(r.cfg.imagery.bands)}, r.store.model(run_id) / "model.json")
    write_json({"test_accuracy": right, "val_loss": best[0] if checked else None, "regularisation": best[1]}, r.store.model(run_id) / "metrics.json")
    return run_id


def scorer_of(r: Region, run_id: str, checkpoint: str | None = None) -> Scorer:
    """The run's model, or another one by its file. A missing one raises FileNotFoundError."""
    path = Path(checkpoint) if checkpoint else r.store.model(run_id) / "model.json"
    if not path.exists():
        raise FileNotFoundError(f"no model at {path}; run train first or name one")
    m = json.loads(path.read_text())
    weights, bias = np.array(m["weights"]) * 10_000, m["bias"]
    return lambda x: 1 / (1 + np.exp(-(x @ weights + bias)))


def clean_negatives(r: Region, run_id: str | None = None, checkpoint: str | None = None) -> None:
    """Scores all chips again and marks negatives that look like solar; what is removed goes to a report."""
    c, score = r.cfg.clean_negatives, scorer_of(r, run_id or r.cfg.run_id(), checkpoint)
    bands = list(r.cfg.imagery.bands)

    def run(parts):
        for pdf in parts:
            yield pdf[["name"]].assign(p=score(np.clip(pdf[bands].to_numpy(float) / 10_000, 0, 1)))

    shares = curation.prediction_share(_pixels(r).mapInPandas(run, "name string, p double"), ["name"], c.prob_threshold)
    index = r.read("chips", "index")
    out = curation.clean_negatives(index.drop("share"), shares, "name", c.max_solar_fraction)
    written(out, "cleaned").write.mode("overwrite").parquet(str(r.store.table("chips", "index")))
    removed = r.read("chips", "index").where("cleaned_out").orderBy(F.desc("share"), "name").select("name", "share").toLocalIterator()
    write_json({"removed": [{"name": x.name, "share": x.share} for x in removed], "max_solar_fraction": c.max_solar_fraction}, r.store.root / "chips" / "clean_negatives_report.json")


def embed_screen(r: Region, only_tiles: list[str] | None = None) -> None:
    """Candidate windows beyond known footprints, by a head fitted on the chips' embeddings.

    An embedding is the mean of each band over a window. Windows of which nearly all lacks data are left out.
    """
    s, patch, bands = r.cfg.screen, r.cfg.model.patch_size, list(r.cfg.imagery.bands)
    path, sections, inputs = r.store.table("screen", "candidates"), ("screen", "model", "imagery"), [r.store.table("chips", "index")]
    if only_tiles is None and is_fresh(path, r.cfg.section(*sections), inputs):
        log.info("%s is fresh", path)
        return
    index = curation.drop_cleaned_out(r.read("chips", "index")).select("name", (F.col("kind") == "pos").alias("is_pos"))
    head = curation.fit_head(curation.pooled(_pixels(r), ["name"], bands).join(index, "name"), "is_pos", steps=s.max_epochs)
    from pyspark.ml.functions import array_to_vector, vector_to_array

    keys, side = ["tile", "range_idx", "row", "col"], r.cfg.imagery.target_resolution_m
    seen = curation.sliding(_rasters(r, only_tiles), keys[:2], patch, curation.stride(patch, s.stride_frac))
    share = seen.groupBy(*keys).agg(F.count("*").alias("n")).where(1 - F.col("n") / float(patch * patch) <= _MOST_NODATA_SCORED)
    windows = curation.pooled(seen, keys, bands).join(share.drop("n"), keys).withColumn("features", array_to_vector("embedding"))
    out = head.transform(windows).withColumn("screen_prob", vector_to_array("probability")[1]).where(F.col("screen_prob") >= s.prob_threshold)
    out = out.join(F.broadcast(r.source("tiles")), "tile")
    x, y = F.col("x") + F.col("col") * side, F.col("y") - F.col("row") * side
    boxes = out.select("tile", x.alias("x1"), (y - patch * side).alias("y1"), (x + patch * side).alias("x2"), y.alias("y2"), "screen_prob")
    if only_tiles is not None and path.exists():
        boxes = replace_tiles(r.read("screen", "candidates"), boxes)
    written(boxes, "candidates").write.mode("overwrite").parquet(str(path))
    write_meta(path, r.cfg.section(*sections), inputs)


def infer(r: Region, run_id: str | None = None, only_tiles: list[str] | None = None, checkpoint: str | None = None) -> None:
    """Pixel probabilities in the windows that touch a region of interest, of all composites in one query.

    Windows of which nearly all lacks data are not scored. A tile and range with results of this run and model is not scored again.
    """
    run_id = run_id or r.cfg.run_id()
    b, patch, score = r.cfg.buildings, r.cfg.model.patch_size, scorer_of(r, run_id, checkpoint)
    side, base = r.cfg.imagery.target_resolution_m, r.store.output(run_id, "prob")
    model = Path(checkpoint) if checkpoint else r.store.model(run_id) / "model.json"
    items = [(i["tile"], i["range_idx"]) for i in read_json(r.store.root / "composites" / "catalogue.json").values() if only_tiles is None or i["tile"] in only_tiles]
    data = r.store.root / "composites" / "data"
    inputs = lambda x: [model, _part(data, *x), r.store.table("buildings", "buildings")]
    settings = r.cfg.section("buildings", "model")
    todo = [x for x in items if not is_fresh(_part(base, *x), settings, inputs(x))]
    if not todo:
        log.info("all results are fresh")
        return
    rois = r.read("buildings", "buildings").where(F.col("area_m2") >= b.areas.scored).select(*spatial.BOX)
    if b.use_screen_candidates:
        rois = rois.unionByName(r.read("screen", "candidates").select(*spatial.BOX))
    keys = ["tile", "range_idx"]
    asked = F.broadcast(r.spark.createDataFrame(todo, "tile string, range_idx int"))  # a row for each composite
    pixels = _rasters(r, [t for t, _ in todo]).join(asked, keys, "left_semi")
    tiles = F.broadcast(r.source("tiles").join(pixels.groupBy(*keys).agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width")), "tile"))
    reach = b.roi_buffer_m + patch * side
    near = (F.col("x2") >= F.col("x") - reach) & (F.col("x1") <= F.col("x") + F.col("width") * side + reach) & (F.col("y1") <= F.col("y") + reach) & (F.col("y2") >= F.col("y") - F.col("height") * side - reach)
    moved = rois.join(tiles, near).select(*keys, "height", "width", (F.col("x1") - F.col("x")).alias("x1"), (F.col("y") - F.col("y2")).alias("y1"), (F.col("x2") - F.col("x")).alias("x2"), (F.col("y") - F.col("y1")).alias("y2"))
    chosen = raster.roi_windows(moved, patch, F.col("height"), F.col("width"), b.roi_buffer_m, side, keys)
    out = raster.score_windows(pixels, chosen, patch, score, list(r.cfg.imagery.bands), keys, _MOST_NODATA_SCORED)
    out.write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(str(base))
    for x in todo:
        if _part(base, *x).exists():
            write_meta(_part(base, *x), settings, inputs(x))


def finish(r: Region, run_id: str | None = None) -> None:
    """Predicted solar, statistics of buildings, and the list of what the map lacks, all by shape."""
    run_id, p = run_id or r.cfg.run_id(), r.cfg.postprocess
    side = r.cfg.imagery.target_resolution_m
    pixels = r.spark.read.parquet(str(r.store.output(run_id, "prob"))).withColumn("tile", F.col("tile").cast("string")).where(F.col("prob") >= p.prob_threshold)
    parts = pixels.select("tile", "range_idx").distinct().withColumn("part", F.row_number().over(Window.orderBy("tile", "range_idx")))  # a row for each composite
    hot = pixels.join(F.broadcast(parts), ["tile", "range_idx"]).join(F.broadcast(r.source("tiles")), "tile")
    hot = hot.select("part", (F.floor(F.col("x") / side) + F.col("c")).alias("c"), (F.floor(-F.col("y") / side) + F.col("r")).alias("r"), F.col("prob").alias("p"))
    found, runs = raster.merged_predictions(hot, "part", p.min_solar_area_m2 / (side * side))
    metres = [(F.col("x1") * side).alias("x1"), (-F.col("y2") * side).alias("y1"), (F.col("x2") * side).alias("x2"), (-F.col("y1") * side).alias("y2")]
    runs = written(runs.select("comp", *metres).join(found.select("comp", F.col("mean_prob").alias("prob")), "comp"), "runs")
    rows = F.array_sort(F.collect_list(geo.box(*[F.col(c) for c in spatial.BOX])[0]))
    boxes = runs.groupBy("comp").agg(F.first("prob").alias("prob"), rows.alias("shape"), F.sum((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area_m2"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    out = r.store.output(run_id, "predicted_solar.parquet")
    boxes.write.mode("overwrite").parquet(str(out))
    solar = r.store.table("osm", "solar")
    known = polygons.with_boxes(r.read("osm", "solar")) if solar.exists() else None
    shaped = polygons.with_boxes(r.read("buildings", "buildings").drop("area_m2", "shape", *spatial.BOX))
    stats = postprocess.shape_solar_stats(shaped, runs, known, p.building_coverage_min).drop("shape")
    at = r.store.output(run_id, "building_solar_stats.parquet")
    stats.write.mode("overwrite").parquet(str(at))
    missing = postprocess.missing_in_osm(r.spark.read.parquet(str(at)))
    missing.write.mode("overwrite").parquet(str(r.store.output(run_id, "missing_in_osm.parquet")))
    write_geojson(missing, r.store.output(run_id, "missing_in_osm.geojson"), ["building_id", "confidence"])


def report(r: Region, run_id: str | None = None) -> Path:
    run_id = run_id or r.cfg.run_id()
    read = lambda name: r.spark.read.parquet(str(r.store.output(run_id, name)))
    missing = read("missing_in_osm.parquet").orderBy(F.desc("confidence"), "building_id")
    layers = {"buildings": (r.read("buildings", "buildings").orderBy("building_id"), ["building_id"]), "predicted solar": (read("predicted_solar.parquet").orderBy("comp"), ["prob"]), "missing": (missing, ["building_id", "confidence", "coverage"])}
    path = r.store.output(run_id, "map.html")
    build_map(layers, path, r.cfg.region)
    return path


def validate(r: Region, run_id: str | None = None) -> dict:
    """Test metrics and counts against the map; precision is a lower bound, as the map lacks some solar."""
    run_id = run_id or r.cfg.run_id()
    out: dict = {}
    metrics = r.store.model(run_id) / "metrics.json"
    if metrics.exists():
        out["chips"] = json.loads(metrics.read_text())
    stats = r.store.output(run_id, "building_solar_stats.parquet")
    if stats.exists():
        own = r.spark.read.parquet(str(stats))
        out["buildings"] = {"n": own.count(), **postprocess.confusion(own).first().asDict()}
    return out


def run_all(r: Region, run_id: str | None = None) -> str:
    aoi(r)
    make_labels(r)
    composite(r)
    buildings(r)
    chips(r)
    pack_chips(r)
    run_id = train(r, run_id)
    if r.cfg.buildings.use_screen_candidates:
        embed_screen(r)
    infer(r, run_id)
    finish(r, run_id)
    report(r, run_id)
    return run_id


def in_batches(r: Region, tiles: list[str], work: Callable[[Region, list[str]], None], size: int = 25, tries: int = 4, pause: float = 30.0) -> None:
    """Composites of a batch of tiles, the work on them, then the batch's composites are deleted: bounded disk.

    A batch that fails is tried again after a pause that doubles, ``tries`` times in all.
    """
    import shutil
    import time

    for k in range(0, len(tiles), size):
        own = tiles[k : k + size]
        for attempt in range(tries):
            try:
                composite(r, own)
                work(r, own)
                break
            except Exception:
                if attempt == tries - 1:
                    raise
                log.exception("batch of %s, attempt %d", own[0], attempt + 1)
                time.sleep(pause * 2**attempt)
        for tile in own:
            shutil.rmtree(r.store.root / "composites" / "data" / f"tile={tile}", ignore_errors=True)
