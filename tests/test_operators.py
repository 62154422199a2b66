import random

import numpy as np
import pytest
from pvscan import testbed
from pvscan.operators import curation, labels, raster, spatial
from pvscan.operators.graph import components
from pvscan.plans import queries
from pyspark.sql import functions as F


def random_boxes(n, seed, size=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rnd.randrange(-300, 700), rnd.randrange(-300, 700)
        w, h = (rnd.randrange(1, size) if rnd.random() < 0.9 else rnd.randrange(200, 900) for _ in range(2))
        rows.append((i, x, y, x + w, y + h))
    return rows


SCHEMA = "id long, x1 long, y1 long, x2 long, y2 long"


@pytest.mark.parametrize("within", [0.0, 35.0])
def test_box_pairs_like_nested_loops(spark, within):
    a, b = random_boxes(150, 1), random_boxes(150, 2)
    got = spatial.box_pairs(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), 64.0, within).select("l_id", "r_id").collect()
    near = lambda lo, hi, lo2, hi2: lo - within <= hi2 and lo2 <= hi + within
    want = {(p[0], q[0]) for p in a for q in b if near(p[1], p[3], q[1], q[3]) and near(p[2], p[4], q[2], q[4])}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_anti_and_empty_sides(spark):
    a = spark.createDataFrame([(1, 0, 0, 10, 10), (2, 100, 0, 110, 10)], SCHEMA)
    b = spark.createDataFrame([(9, 40, 0, 45, 10)], SCHEMA)
    assert [r.id for r in spatial.anti(a, b, "id", within=50).collect()] == [2]
    assert spatial.anti(a, b.limit(0), "id", within=50).count() == 2
    assert spatial.marked(a, b.limit(0), "id", "hit").where("hit").count() == 0


@pytest.mark.parametrize("local", [1 << 20, 30])
def test_components_like_search(spark, local):
    rnd = random.Random(7)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2060)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), local=local).collect()}
    edges.remove((None, 3))
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    assert set(got) == set(near)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for k in near[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        assert got[start] == min(seen)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pixel_components_across_blocks(spark):
    rng = np.random.default_rng(0)
    hot = rng.random((40, 40)) < 0.45
    rows = [(int(r * 40 + c), int(r), int(c), 1.0) for r, c in zip(*np.nonzero(hot), strict=True)]
    df = spark.createDataFrame(rows, "id long, r long, c long, p double")
    small, whole = ({r.id: r.comp for r in raster.pixel_components(df, b).collect()} for b in (7, 1000))
    assert small == whole
    up = {(r, c): whole[i] for i, r, c, _ in rows}
    assert all(up[r, c] == up[n] for r, c in up for n in ((r + 1, c), (r, c + 1)) if n in up)


@pytest.mark.parametrize(("record", "want"), [("w98@3", ("way", 98)), ("n60051000777@12", ("node", 60051000777)), ("r7@1", ("relation", 7)), (None, (None, None)), ("garbage", (None, None)), ("x5@1", (None, 5))])
def test_record_ids(spark, record, want):
    kind, ident = labels.parse_record_id(F.col("r"))
    assert tuple(spark.createDataFrame([(record,)], "r string").select(kind, ident).first()) == want


def test_location_tags(spark):
    df = spark.createDataFrame([({"location": "", "generator:place": "roof"},), ({"generator:location": "x"},), ({},)], "t map<string,string>")
    assert [tuple(r) for r in df.select(labels.first_filled_tag(F.col("t")), labels.first_present_tag(F.col("t"))).collect()] == [("roof", ""), ("x", "x"), (None, None)]


def test_rooftop_rules(spark):
    buildings = spark.createDataFrame([(1, 0, 0, 50, 50)], "building_id long, x1 long, y1 long, x2 long, y2 long")
    solar = spark.createDataFrame([(1, 0, 0, 30, 30, False), (2, 20, 0, 50, 30, None), (3, 500, 0, 540, 40, True), (4, 900, 0, 940, 40, False), (5, 940, 0, 960, 40, False), (6, 2000, 0, 2001, 1, True)], "osm_id long, x1 long, y1 long, x2 long, y2 long, roof boolean")
    run = lambda rule: {r.group: r for r in labels.build_labels(solar, buildings, 1000.0, rule).collect()}
    assert sorted(run("intersect_or_roof_tag")) == ["b1", "c3"] and sorted(run("roof_tag_only")) == ["c3"]
    assert run("intersect_only")["b1"].area_m2 == 1500 and run("intersect_only")["b1"].n == 2
    with pytest.raises(ValueError):
        labels.build_labels(solar, buildings, 1, "other")


def test_sources_in_order(spark):
    a = spark.createDataFrame([(i, 10 * i, 0, 10 * i + 5, 5) for i in range(3)], SCHEMA)
    b = spark.createDataFrame([(10, 1, 1, 3, 3), (11, 100, 0, 105, 5), (12, 101, 1, 103, 3)], SCHEMA)
    out = labels.dedupe_sources([a, b])
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 11, 12]
    numbered = labels.with_building_id(out, ["id"]).orderBy("building_id").collect()
    assert [(r.building_id, r.id) for r in numbered] == list(enumerate([0, 1, 2, 11, 12]))


def test_composite_rounds_half_to_even_and_skips_invalid(spark):
    obs = spark.createDataFrame([(1, 4, 2.0), (1, 5, 3.0), (1, 9, 100.0), (1, 4, 0.0), (2, 9, 7.0)], "pixel long, scl int, value double")
    assert {r.pixel: r.value for r in raster.composite(obs, ["pixel"]).collect()} == {1: 2, 2: 0}
    assert {r.pixel: r.value for r in raster.composite(obs, ["pixel"], "mean", None).collect()} == {1: 35, 2: 7}
    with pytest.raises(ValueError):
        raster.composite(obs, ["pixel"], "medoid")


def test_windows_and_masks(spark):
    assert raster.windows(100, 70, 64) == [(0, 0), (0, 64), (64, 0), (64, 64)]
    rois = random_boxes(60, 5)
    got = {tuple(r) for r in raster.roi_windows(spark.createDataFrame(rois, SCHEMA), 64, 500, 400, 3.0).collect()}
    want = {(r, c) for r, c in raster.windows(500, 400, 64) for _, x1, y1, x2, y2 in rois if x1 - 3 <= c + 64 and x2 + 3 >= c and y1 - 3 <= r + 64 and y2 + 3 >= r and x1 - 3 <= 400 and y1 - 3 <= 500 and x2 + 3 >= 0 and y2 + 3 >= 0}
    assert got == want
    mask = raster.rasterised(spark.createDataFrame([(1, 10, 10, 20, 20), (2, 15, 15, 25, 20)], SCHEMA), "id")
    assert mask.count() == 125 and mask.where("id = 2").count() == 25


def test_splits():
    split = curation.split_blocks(list(range(20)) * 2, 0.7, 0.15, 1)
    assert sorted(split) == list(range(20)) and {"train", "val", "test"} == set(split.values())
    assert sum(v == "train" for v in split.values()) == 14 and sum(v == "val" for v in split.values()) == 3
    assert split == curation.split_blocks(list(range(20)), 0.7, 0.15, 1)
    assert set(curation.split_blocks([1, 2], 0.7, 0.15, 1).values()) == {"train", "val"}
    assert curation.split_blocks([], 0.7, 0.15, 1) == {}


def test_cleaning_and_pool(spark):
    index = spark.createDataFrame([("a", "neg"), ("b", "neg"), ("c", "pos"), ("d", "neg")], "name string, kind string")
    shares = spark.createDataFrame([("a", 0.5), ("b", 0.04), ("c", 0.9)], "name string, share double")
    marked = curation.clean_negatives(index, shares, "name", 0.05)
    again = curation.clean_negatives(marked.drop("share"), shares, "name", 0.05)
    for out in (marked, again):
        assert {r.name for r in out.where("cleaned_out").collect()} == {"a"}
    assert curation.drop_cleaned_out(index).count() == 4
    assert curation.drop_cleaned_out(spark.createDataFrame([(None,), (True,), (False,)], "cleaned_out boolean")).count() == 2
    pool = curation.chip_pool({"nl": marked.withColumn("split", F.lit("val")), "de": index.withColumn("split", F.lit("test"))})
    assert pool.count() == 7 and curation.split_of(pool, "test", "nl").count() == 3
    with pytest.raises(ValueError):
        curation.chip_pool({"nl": index, "de": None})
    with pytest.raises(ValueError):
        curation.chip_pool({"nl": index.withColumn("channels", F.lit(4))}, channels=10)


def test_head_at_the_mean_gives_the_bias(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "e array<float>")
    p = df.select(curation.head_score(F.col("e"), [1, 2, 3], [1, 1, 1], [5, 6, 7], 0.5)).first()[0]
    assert p == pytest.approx(1 / (1 + np.exp(-0.5)))


def test_jitter_and_augmentation(spark):
    rng = np.random.default_rng(0)
    own = spark.range(50).select(*[x.alias(n) for n, x in zip("rc", curation.jittered_corner(F.lit(100.5), F.lit(200.5), 64, F.col("id").cast("string"), 7), strict=True)]).collect()
    assert all(abs(x.r + 32 - 100) <= 16 and abs(x.c + 32 - 200) <= 16 for x in own) and len({x.r for x in own}) > 10
    image = np.arange(32).reshape(2, 4, 4)
    a, b = curation.augmented(image, image[0], rng)
    assert sorted(a[0].ravel()) == list(range(16)) and (a[0] == b).all()
    assert curation.stride(64, 0.5) == 32 and curation.stride(1, 0.1) == 1


@pytest.mark.parametrize(("how", "seed"), [("shuffled", 3), ("hashed", 3), ("hashed", 4)])
def test_splits_never_divide_blocks(spark, how, seed):
    points = spark.createDataFrame([(i, float(i * 313 % 9000), float(i * 717 % 7000)) for i in range(400)], "id int, x double, y double")
    rows = curation.assign_splits(points, F.col("x"), F.col("y"), 1.0, 0.6, 0.2, seed, how).collect()
    by = {}
    for r in rows:
        by.setdefault(r.block, set()).add(r.split)
    assert len(rows) == 400 and all(len(s) == 1 for s in by.values())
    a, b = curation.split_sizes(len(by), 0.6, 0.2)
    assert [sum(s == {x} for s in by.values()) for x in ("train", "val", "test")] == [a, b, len(by) - a - b]


def test_subset_of_tiles(spark):
    few, many = (spark.createDataFrame([(x,) for x in xs], "tile string") for xs in (["a", "b", "a"], ["a", "b", "c"]))
    assert curation.all_in(few, many, "tile") and not curation.all_in(many, few, "tile")


def test_labels_on_every_order_like_brute_force(spark):
    """The label queries against brute force, on the table of all orders."""
    sf = "/root/testdata/sf0.001"
    solar = sorted(tuple(r) for r in testbed.table(spark, sf, "v_solar_dense").select("osm_id", *spatial.BOX).collect())
    buildings = [tuple(r) for r in testbed.table(spark, sf, "v_buildings").select("building_id", *spatial.BOX).collect()]
    assert len(solar) == spark.read.parquet(f"{sf}/orders.parquet").count()
    on = {s[0]: min((b[0] for b in buildings if s[1] <= b[3] and b[1] <= s[3] and s[2] <= b[4] and b[2] <= s[4]), default=None) for s in solar}
    loose = [s for s in solar if on[s[0]] is None]
    root = {s[0]: s[0] for s in loose}
    for i, a in enumerate(loose):
        for b in loose[:i]:
            w, h = min(a[3], b[3]) - max(a[1], b[1]), min(a[4], b[4]) - max(a[2], b[2])
            if min(w, h) >= 0 and max(w, h) > 0 and root[a[0]] != root[b[0]]:
                old, new = sorted((root[a[0]], root[b[0]]))[::-1]
                root = {k: new if v == old else v for k, v in root.items()}
    group = {k: f"c{root[k]}" if b is None else f"b{b}" for k, b in on.items()}
    got = queries.label_groups(spark, sf).collect()
    assert sorted((r.osm_id, r.building, r.group) for r in got) == [(s[0], on[s[0]], group[s[0]]) for s in solar]
    want = {}
    for g in set(group.values()):
        own = [s for s in solar if group[s[0]] == g]
        x0, y0 = min(s[1] for s in own), min(s[2] for s in own)
        cells = np.zeros((max(s[3] for s in own) - x0, max(s[4] for s in own) - y0), bool)
        for _, x1, y1, x2, y2 in own:
            cells[x1 - x0 : x2 - x0, y1 - y0 : y2 - y0] = True
        tag = any(s[0] % 7 == 0 for s in own)
        if cells.sum() >= 1000 and (g[0] == "b" or tag):
            want[g] = (own[0][0], tag, g[0] == "b", len(own), float(cells.sum()))
    got = {r["group"]: (r.osm_id, r.has_roof_tag, r.on_building, r.n, r.area_m2) for r in queries.build_labels(spark, sf).collect()}
    assert got == want
