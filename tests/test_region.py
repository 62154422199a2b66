"""Configuration, artifacts, sources, and a small region from boundary to map."""

import json

import numpy as np
import pytest
from pvscan import artifacts, cli
from pvscan.config import ConfigError, parse_config
from pvscan.plans import stages
from pvscan.sources import vectors
from pyspark.sql import functions as F

BASE = {"region": "x", "aoi": {"source": "bbox", "bbox": [11.40, 48.02, 11.58, 48.18]}, "imagery": {"date_ranges": [["2025-06-01", "2025-07-31"]]}}


def changed(**sections):
    return {**BASE, **{k: {**BASE.get(k, {}), **v} if isinstance(v, dict) else v for k, v in sections.items()}}


@pytest.mark.parametrize("bad", [
    changed(aoi={"bbox": [7, 51, 6, 52]}), changed(aoi={"source": "geoboundaries"}), {**BASE, "aoi": {"source": "bbox"}},
    changed(imagery={"date_ranges": []}), changed(imagery={"date_ranges": [["2025-07-01", "2025-06-01"]]}), changed(imagery={"stac_source": "cdse_mosaics"}),
    changed(imagery={"cloud_mask": "omnicloudmask"}), changed(imagery={"composite_method": "medoid"}), changed(split={"ratios": {"train": 0.9}}), changed(osm={"rooftop_rule": "any"}), changed(osm={"what": 1}), {"region": "x"},
])
def test_invalid_settings(bad):
    with pytest.raises(ConfigError):
        parse_config(bad)


def test_defaults_and_run_id():
    cfg = parse_config(BASE)
    assert cfg.imagery.collection == "sentinel2-temporal-mosaics" and len(cfg.imagery.bands) == 10 and len(cfg.run_id()) == 10
    assert cfg.buildings.areas == (1000, 1000) and parse_config(changed(buildings={"roi_area_min_m2": 450})).buildings.areas == (450, 450)
    same = [changed(buildings={"roi_area_min_m2": 5}), changed(postprocess={"prob_threshold": 0.9}), changed(clean_negatives={"prob_threshold": 0.9})]
    assert {parse_config(c).run_id() for c in same} == {cfg.run_id()}
    assert parse_config(changed(chips={"neg_ratio": 1})).run_id() != cfg.run_id()


def test_freshness(tmp_path):
    table, source = tmp_path / "t.parquet", tmp_path / "in.json"
    source.write_text("1")
    table.write_text("t")
    assert not artifacts.is_fresh(table, {"a": 1}, [source])
    artifacts.write_meta(table, {"a": (1, 2)}, [source])
    assert artifacts.is_fresh(table, {"a": [1, 2]}, [source]) and not artifacts.is_fresh(table, {"a": 3}, [source])
    other = tmp_path / "new.json"
    other.write_text("2")
    assert not artifacts.is_fresh(table, {"a": [1, 2]}, [source, other])
    source.write_text("changed")
    assert not artifacts.is_fresh(table, {"a": [1, 2]}, [source])
    source.unlink()
    assert artifacts.is_fresh(table, {"a": [1, 2]}, [source])


def test_catalogue(spark, tmp_path):
    path = tmp_path / "c" / "catalogue.json"
    assert artifacts.register_composite(path, "32UPU", 0, bands=["B02"]) and not artifacts.register_composite(path, "32UPU", 0, bands=["B02"])
    assert artifacts.register_composite(path, "32UPU", 0, bands=["B03"]) and artifacts.composites(spark, path).count() == 1
    path.write_text("{broken")
    assert artifacts.register_composite(path, "31UDQ", 1) and [p.name for p in path.parent.iterdir()] == ["catalogue.json"]


def test_queries_of_the_map():
    q = vectors.solar_query((6.0, 51.0, 7.0, 52.0), 60)
    assert "(51.0,6.0,52.0,7.0)" in q and q.startswith("[out:json][timeout:60];") and q.count("relation[") == 2
    assert vectors.buildings_query([(1, 2, 3, 4)] * 3, 9).count("way[") == 3
    assert vectors.theme_path("s3a://b/", "r1", "base", "infrastructure") == "s3a://b/release/r1/theme=base/type=infrastructure"
    assert len(vectors.cache_name(q)) == 29


def test_elements(spark, tmp_path):
    ring = [{"lat": 0.0, "lon": 0.0}, {"lat": 0.0, "lon": 4.0}, {"lat": 4.0, "lon": 4.0}, {"lat": 0.0, "lon": 0.0}]
    inner = [{"lat": 1.0, "lon": 2.0}, {"lat": 1.0, "lon": 3.0}, {"lat": 2.0, "lon": 3.0}, {"lat": 1.0, "lon": 2.0}]
    elements = [
        {"type": "way", "id": 1, "tags": {"z": "1", "location": "roof"}, "geometry": ring}, {"type": "way", "id": 2, "geometry": ring[:3]}, {"type": "node", "id": 3},
        {"type": "relation", "id": 4, "tags": {}, "members": [{"type": "way", "ref": 7, "role": "outer", "geometry": ring}, {"type": "way", "ref": 8, "role": "inner", "geometry": inner}]}, {"type": "way", "id": 1, "tags": {"z": "1", "location": "roof"}, "geometry": ring},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"version": 0.6, "elements": elements}, indent=1))
    rows = {r.osm_id: r for r in vectors.elements_to_polygons(vectors.read_responses(spark, str(tmp_path))).collect()}
    assert sorted(rows) == [1, 4] and rows[1].location_tag == "roof" and rows[1].tags == '{"location":"roof","z":"1"}'
    assert len(rows[4].geom) == 1 and len(rows[4].geom[0]) == 2


def test_boundaries(spark, tmp_path):
    square = [[[6, 51], [7, 51], [7, 52], [6, 52], [6, 51]]]
    features = [{"type": "Feature", "properties": {"shapeName": n}, "geometry": {"type": t, "coordinates": c}} for n, t, c in (("Lahore", "Polygon", square), ("Other", "MultiPolygon", [square, square]))]
    path = tmp_path / "b.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    assert vectors.boundary(spark, str(path), "LAHORE").first().name == "Lahore"
    assert len(vectors.boundary(spark, str(path), "other").first().geom) == 2
    with pytest.raises(KeyError, match="Lahore, Other"):
        vectors.boundary(spark, str(path), "nowhere")


def geom(lon, lat, w, h):
    dx, dy = w / 74_400.0, h / 111_200.0
    return [[[{"x": lon + a * dx, "y": lat + b * dy} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]]]


GEOM = "array<array<array<struct<x:double,y:double>>>>"


@pytest.fixture(scope="module")
def region(spark, tmp_path_factory):
    """Ten buildings in a row; solar is mapped on the first three, and bright pixels lie on the first five."""
    root = tmp_path_factory.mktemp("region")
    box = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"
    bounds = lambda g: (min(p["x"] for p in g[0][0]), max(p["x"] for p in g[0][0]), min(p["y"] for p in g[0][0]), max(p["y"] for p in g[0][0]))
    roofs = [geom(11.42 + 0.011 * i, 48.10, 80, 80) for i in range(10)]
    panels = [geom(11.42 + 0.011 * i, 48.10, 60, 60) for i in range(3)]
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{root}/inputs/{name}.parquet")
    save([(f"b{i}", bounds(g), g) for i, g in enumerate(roofs)], f"id string, bbox {box}, geom {GEOM}", "buildings")
    save([(f"s{i}", bounds(g), "power", [(f"w{i + 1}@1",)], {"generator:source": "solar", "location": "roof"}, g) for i, g in enumerate(panels)], f"id string, bbox {box}, subtype string, sources array<struct<record_id:string>>, source_tags map<string,string>, geom {GEOM}", "infrastructure")
    return root, roofs


def test_region_from_boundary_to_map(spark, region, tmp_path):
    root, roofs = region
    raw = changed(imagery={"stac_source": "planetary_computer", "bands": ["B02", "B03"], "tiles": ["32UPU"]}, model={"patch_size": 16}, chips={"pos_per_label": 2, "neg_ratio": 1}, split={"block_size_km": 1})
    r = stages.Region(spark, parse_config({**raw, "data_dir": str(root / "data")}), root / "inputs")
    stages.aoi(r)
    assert json.loads((r.store.root / "aoi" / "tiles.json").read_text()) == ["32UPU"]
    stages.make_labels(r)
    found = r.read("osm", "labels").collect()
    assert sorted(x.group for x in found) == ["bb0", "bb1", "bb2"] and all(x.has_roof_tag and x.on_building and 3000 < x.area_m2 < 4200 for x in found)
    assert r.read("osm", "buildings").count() == 3
    stages.buildings(r)
    own = r.read("buildings", "buildings").orderBy("building_id").collect()
    assert len(own) == 10 and [b.building_id for b in own] == list(range(10))
    # pixels of 10 m around the buildings, bright where the first five have panels or would have them
    x0, y0 = min(b.x1 for b in own) - 200, max(b.y2 for b in own) + 200
    inside = lambda x, y, n: any(b.x1 <= x <= b.x1 + 60 and b.y1 <= y <= b.y1 + 60 for b in own if b.id in {f"b{i}" for i in range(n)})
    width, height = int((max(b.x2 for b in own) + 200 - x0) / 10), int((y0 - min(b.y1 for b in own) + 200) / 10)
    pixels = [(row, col, 8000 if inside(x0 + 10 * col + 5, y0 - 10 * row - 5, 5) else 500) for row in range(height) for col in range(width)]
    obs = [(i, "32UPU", row, col, band, 4, float(v)) for i in (1, 2) for row, col, v in pixels for band in ("B02", "B03")]
    obs += [(3, "32UPU", row, col, "B02", 9, 9000.0) for row, col, _ in pixels]  # clouded all over
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{root}/inputs/{name}.parquet")
    write(obs, "item_id long, tile string, r long, c long, band string, scl int, value double", "observations")
    write([(i, "32UPU", f"2025-06-0{i} 10:00:00", 5.0, "sentinel-2-l2a") for i in (1, 2)] + [(3, "32UPU", "2021-06-01 10:00:00", 5.0, "sentinel-2-l2a")], "item_id long, tile string, ts string, cloud double, collection string", "scenes")
    write([("32UPU", float(x0), float(y0))], "tile string, x double, y double", "tiles")
    stages.composite(r)
    catalogue = r.store.root / "composites" / "catalogue.json"
    assert artifacts.composites(spark, catalogue).count() == 1
    elsewhere = lambda *dates: stages.Region(spark, parse_config({**changed(imagery={"stac_source": "planetary_computer", "bands": ["B02"], "date_ranges": [list(dates)]}), "data_dir": str(root / "data")}), root / "inputs")
    with pytest.raises(RuntimeError):
        stages.composite(elsewhere("2020-01-01", "2020-02-01"), ["32UPU"])
    stages.composite(r)
    values = {tuple(x) for x in stages._rasters(r).select("B02", "B03").distinct().collect()}
    assert values == {(8000, 8000), (500, 500)} and stages._rasters(r).count() == len(pixels)
    stages.chips(r)
    index = r.read("chips", "index")
    assert index.where("kind = 'pos'").count() == 6 and index.groupBy("block").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    chips = {x.name: x for x in index.collect()}
    hot = {name: 0 for name in chips}
    for x in r.read("chips", "pixels").collect():
        chip, at = chips[x.name], divmod(x["at"], 16)
        row, col = chip.row + at[0], chip.col + at[1]
        panel = inside(x0 + 10 * col + 5, y0 - 10 * row - 5, 3)
        assert x.B02 == pixels[row * width + col][2] and abs(x.label - panel) <= (0 if x.label == panel else 1)
        hot[x.name] += x.label
    assert all((n >= 20) == (chips[name].kind == "pos") for name, n in hot.items())
    stages.pack_chips(r)
    packed = r.read("chips", "packed")
    assert sorted(x.h5_row for x in packed.collect()) == list(range(index.count()))
    some = stages.unpacked(packed, [0, 2], ["B02", "B03"]).collect()
    assert {x.h5_row for x in some} == {0, 2} and {(x.name, x["at"], x.B02, x.label) for x in some} == {(x.name, x["at"], x.B02, x.label) for x in r.read("chips", "pixels").collect() if x.name in {y.name for y in some}}
    run = stages.train(r)
    assert json.loads((r.store.model(run) / "metrics.json").read_text())["test_accuracy"] > 0.8
    stages.infer(r)
    before = sorted(p.stat().st_mtime_ns for p in r.store.output(run, "prob").rglob("*.parquet"))
    stages.infer(r)  # nothing to do
    assert before == sorted(p.stat().st_mtime_ns for p in r.store.output(run, "prob").rglob("*.parquet"))
    stages.finish(r)
    counts = stages.validate(r)["buildings"]
    assert (counts["n"], counts["tp"], counts["fp"], counts["fn"]) == (10, 3, 2, 0)
    found = spark.read.parquet(str(r.store.output(run, "predicted_solar.parquet"))).collect()
    assert len(found) == 5 and all(abs(x.area_m2 - 3600) < 1300 for x in found)
    missing = spark.read.parquet(str(r.store.output(run, "missing_in_osm.parquet")))
    assert missing.count() == 2 and len(json.loads(r.store.output(run, "missing_in_osm.geojson").read_text())["features"]) == 2
    assert "missing: 2" in stages.report(r).read_text()
    with pytest.raises(FileNotFoundError):
        stages.scorer_of(r, "none")
    stages.embed_screen(r)
    assert r.read("screen", "candidates").where("screen_prob < 0.5").count() == 0
    stages.clean_negatives(r)
    bright = {c.name for c in chips.values() if c.kind == "neg" and c.fid in {f"n{b.building_id}" for b in own if b.id in ("b3", "b4")}}
    assert {x.name for x in r.read("chips", "index").where("cleaned_out").collect()} <= bright


def test_command_line():
    args = cli.parser().parse_args(["infer", "-c", "a.yaml", "--tiles", "32UPU, 31UDQ", "--model-ckpt", "m"])
    assert args.tiles == ["32UPU", "31UDQ"] and args.model_ckpt == "m" and args.run_id is None
    assert set(cli.COMMANDS) >= {"aoi", "labels", "composite", "buildings", "chips", "pack-chips", "train", "clean-negatives", "embed-screen", "infer", "postprocess", "report", "validate", "run-all"}
