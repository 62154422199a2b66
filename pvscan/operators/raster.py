"""Raster work on long pixel tables: scene choice, composites, windows, masks, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pvscan.functions import geo
from pvscan.operators import spatial
from pvscan.operators.graph import components, united
from pvscan.scratch import written

#: Scene classes that count as clear (fixed values).
CLEAR = (4, 5, 6, 7)


def clearest_scenes(scenes: DataFrame, collection: str, max_cloud: float, most: int = 15, start: str | None = None, end: str | None = None) -> DataFrame:
    """Of each tile the clearest scene of a day, and of those the ``most`` clearest; ties by time, then id.

    The interval is closed and compared by day.
    """
    own = scenes.where((F.col("collection") == collection) & (F.col("cloud") < max_cloud))
    if start is not None and end is not None:
        own = own.where(F.to_date("ts").between(F.lit(start), F.lit(end)))
    daily = Window.partitionBy("tile", F.to_date("ts")).orderBy("cloud", "ts", "item_id")
    own = own.withColumn("k", F.row_number().over(daily)).where("k = 1")
    best = Window.partitionBy("tile").orderBy("cloud", "ts", "item_id")
    return own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).drop("k")


def composite(obs: DataFrame, keys: list[str], how: str = "median", clear: tuple[int, ...] | None = CLEAR) -> DataFrame:
    """Reduces observations (keys, value and, unless ``clear`` is None, scl) over time; invalid ones are left out.

    A value counts if it is above 0 and its class is clear. Results are rounded half to even; 0 is nodata.
    """
    if how not in ("median", "mean"):
        raise ValueError(f"unknown reducer {how!r}")
    valid = F.col("value") > 0
    if clear is not None:
        valid &= F.col("scl").isin(*clear)
    value = F.when(valid, F.col("value").cast("double"))
    reduced = F.median(value) if how == "median" else F.avg(value)
    return obs.groupBy(*keys).agg(F.rint(F.coalesce(reduced, F.lit(0.0))).cast("int").alias("value"))


def daily_mosaic(obs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One value for each key and day: the first valid one in the given order."""
    first = F.min_by(F.col("value"), F.struct(*order))
    return obs.where("value > 0").groupBy(*keys, "day").agg(first.alias("value"))


def windows(height: int, width: int, patch: int, stride: int | None = None) -> list[tuple[int, int]]:
    """Upper left corners of windows over a raster, row by row; those at the edges may reach beyond it."""
    return [(r, c) for r in range(0, height, stride or patch) for c in range(0, width, stride or patch)]


def roi_windows(boxes: DataFrame, patch: int, height: int | Column | None = None, width: int | Column | None = None, buffer: float = 0.0, pixel: float = 1.0, keys: list[str] = ()) -> DataFrame:
    """Distinct windows (keys, row, col: of the upper left pixel) that touch a box grown by ``buffer``; coordinates in metres, y down.

    Each box names the windows it covers; no window is tested against all boxes. ``height`` and ``width`` of the raster may be columns of ``boxes``;
    without them it has no end.
    """
    size = patch * pixel
    end = lambda n: n if isinstance(n, Column) else F.lit(n).cast("bigint")
    boxes = boxes.withColumn("height", end(height)).withColumn("width", end(width))
    first = lambda lo: F.greatest(F.ceil((F.col(lo) - buffer) / size) - 1, F.lit(0))
    # least() passes over nulls
    last = lambda hi, most: F.least(F.floor((F.col(hi) + buffer) / size), F.floor((F.col(most) - 1) / patch))
    before = lambda lo, most: F.coalesce(F.col(lo) - buffer <= F.col(most) * pixel, F.lit(True))
    inside = (F.col("x2") + buffer >= 0) & (F.col("y2") + buffer >= 0) & before("x1", "width") & before("y1", "height")
    own = boxes.where(inside & (first("x1") <= last("x2", "width")) & (first("y1") <= last("y2", "height")))
    own = own.select(*keys, F.explode(F.sequence(first("y1"), last("y2", "height"))).alias("i"), "x1", "x2", "width")
    own = own.select(*keys, "i", F.explode(F.sequence(first("x1"), last("x2", "width"))).alias("j"))
    return own.select(*keys, (F.col("i") * patch).cast("bigint").alias("row"), (F.col("j") * patch).cast("bigint").alias("col")).distinct()


def cut_windows(windows_: DataFrame, pixels: DataFrame, keys: list[str], patch: int) -> DataFrame:
    """The pixels in each of ``windows_`` (keys, row, col and others; they may overlap and lie at any pixel), with k: the place in the window.

    A window and a pixel meet by the block of ``patch`` pixels that the pixel is in; a window touches four at most. The join is by sorting, see ``labelled``. What lies beyond the raster has no row.
    """
    block = lambda c: F.floor(F.col(c) / patch)
    both = lambda c: F.explode(F.array_distinct(F.array(block(c), F.floor((F.col(c) + patch - 1) / patch))))
    wide = windows_.withColumn("br", both("row")).withColumn("bc", both("col"))
    own = wide.hint("merge").join(pixels.withColumn("br", block("r")).withColumn("bc", block("c")), [*keys, "br", "bc"])
    dr, dc = F.col("r") - F.col("row"), F.col("c") - F.col("col")
    return own.where((dr >= 0) & (dr < patch) & (dc >= 0) & (dc < patch)).withColumn("k", (dr * patch + dc).cast("int")).drop("br", "bc")


def labelled(pixels: DataFrame, shapes: DataFrame, keys: list[str], pixel: float, block: int = 64) -> DataFrame:
    """``pixels`` (keys, r, c and others; r down from y = 0) with label: 1 where their centre is inside one of ``shapes`` (keys, shape and its box in metres, y up), else 0.

    Shapes and pixels meet by blocks of ``block`` pixels, so no shape is laid out in pixels that the raster lacks. Both joins are by sorting: the planner
    takes a table that was exploded for as small as it was before, and would broadcast it whole.
    """
    at = lambda lo, hi: F.explode(F.sequence(F.floor(lo / (pixel * block)).cast("long"), F.floor(hi / (pixel * block)).cast("long")))
    wide = shapes.select(*keys, "shape", *spatial.BOX).withColumn("br", at(-F.col("y2"), -F.col("y1"))).withColumn("bc", at(F.col("x1"), F.col("x2")))
    spots = pixels.select(*keys, "r", "c", F.floor(F.col("r") / block).alias("br"), F.floor(F.col("c") / block).alias("bc"))
    x, y = (F.col("c") + 0.5) * pixel, -(F.col("r") + 0.5) * pixel
    met = spots.join(wide.hint("merge"), [*keys, "br", "bc"]).where(x.between(F.col("x1"), F.col("x2")) & y.between(F.col("y1"), F.col("y2")))
    inside = met.where(geo.covers_point(F.col("shape"), x, y)).select(*keys, "r", "c").distinct().withColumn("label", F.lit(1))
    return pixels.join(inside.hint("merge"), [*keys, "r", "c"], "left").fillna(0, ["label"])


def nodata_share(pixels: DataFrame, keys: list[str], patch: int) -> DataFrame:
    """For each window with pixels: how large a part of it has no data (pixel absent, or all bands 0)."""
    own = pixels.withColumn("row", F.floor(F.col("r") / patch) * patch).withColumn("col", F.floor(F.col("c") / patch) * patch)
    seen = F.count_if(F.col("value") > 0)
    return own.groupBy(*keys, "row", "col").agg((F.lit(1.0) - seen / F.lit(float(patch * patch))).alias("nodata"))


def rasterised(boxes: DataFrame, key: str) -> DataFrame:
    """Pixels of one metre whose centre lies in a box: r, c and the least ``key`` burnt there."""
    inner = lambda lo, hi: F.sequence(F.ceil(F.col(lo) - 0.5), F.ceil(F.col(hi) - 0.5) - 1)
    wide = boxes.where((F.ceil(F.col("x2") - 0.5) > F.ceil(F.col("x1") - 0.5)) & (F.ceil(F.col("y2") - 0.5) > F.ceil(F.col("y1") - 0.5)))
    each = wide.select(key, "x1", "x2", F.explode(inner("y1", "y2")).alias("r")).select(key, "r", F.explode(inner("x1", "x2")).alias("c"))
    return each.groupBy("r", "c").agg(F.min(key).alias(key))


def mask_counts(boxes: DataFrame, key: str, patch: int) -> DataFrame:
    """Label pixels in each window (row, col) that has any."""
    at = lambda c: (F.floor(F.col(c) / patch) * patch).cast("bigint")
    return rasterised(boxes, key).groupBy(at("r").alias("row"), at("c").alias("col")).agg(F.count("*").alias("label_pixels"))


def _local_components(pdf: pd.DataFrame) -> pd.DataFrame:
    """Components of one block's pixels by the four neighbours; a component is named by its least id."""
    pdf = pdf.sort_values("id", ignore_index=True)
    r, c = pdf.r.to_numpy(), pdf.c.to_numpy()
    wide = int(c.max() - c.min()) + 2
    place = (r - r.min()) * wide + (c - c.min())
    order = np.argsort(place)
    own = place[order]
    edges = []
    for step in (1, wide):
        at = np.minimum(np.searchsorted(own, own + step), len(own) - 1)
        hit = own[at] == own + step
        edges.append((order[hit], order[at[hit]]))
    node, root = united(*(np.concatenate(x) for x in zip(*edges, strict=True)))
    local = np.arange(len(pdf))
    local[node] = root
    return pdf.assign(local=pdf.id.to_numpy()[local])[[x for x in pdf.columns if x not in ("br", "bc")] + ["local"]]


def pixel_components(pixels: DataFrame, block: int = 256, keys: list[str] = ()) -> DataFrame:
    """``pixels`` (id, r, c, ...) with comp: the least id of its four-connected component, among pixels of equal ``keys``.

    Blocks of ``block`` pixels square are labelled by themselves; components that meet across block edges
    are joined through a graph of their labels. Ids are unique, also between keys.
    """
    own = pixels.select("id", "r", "c", *keys).withColumn("br", F.floor(F.col("r") / block)).withColumn("bc", F.floor(F.col("c") / block))
    own = own.select("id", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), *keys, "br", "bc")
    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields if f.name not in ("br", "bc"))
    local = own.groupBy(*keys, "br", "bc").applyInPandas(_local_components, f"{named}, local long")
    edge = local.where((F.pmod("r", F.lit(block)) == 0) | (F.pmod("c", F.lit(block)) == 0) | (F.pmod("r", F.lit(block)) == block - 1) | (F.pmod("c", F.lit(block)) == block - 1))
    steps = edge.select(*keys, F.col("local").alias("a"), F.explode(F.array(F.struct((F.col("r") + 1).alias("r"), F.col("c").alias("c")), F.struct(F.col("r").alias("r"), (F.col("c") + 1).alias("c")))).alias("n")).select(*keys, "a", "n.r", "n.c")
    seams = steps.join(edge.select(*keys, "r", "c", F.col("local").alias("b")), [*keys, "r", "c"]).where("a <> b").select("a", "b")
    joined = components(seams)
    label = local.join(joined.withColumnRenamed("node", "local"), "local", "left").select("id", F.coalesce("root", "local").alias("comp"))
    return pixels.join(label, "id")


def predicted_solar(pixels: DataFrame, threshold: float, min_pixels: int = 1, block: int = 256) -> DataFrame:
    """Hot pixels as components: comp, n_pixels, mean_prob, x1, y1, x2, y2 (of one-metre pixels)."""
    hot = pixel_components(pixels.where(F.col("p") >= threshold), block)
    each = hot.groupBy("comp").agg(F.count("*").alias("n_pixels"), F.avg("p").alias("mean_prob"), F.min("c").alias("x1"), F.min("r").alias("y1"), (F.max("c") + 1).alias("x2"), (F.max("r") + 1).alias("y2"))
    return each.where(F.col("n_pixels") >= min_pixels)


def pixel_runs(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of neighbouring pixels in a row as boxes: keys, x1, y1, x2, y2 (of one-metre pixels). Together they are the pixels, each once."""
    along = Window.partitionBy(*keys, "r").orderBy("c")
    own = pixels.select(*keys, "r", "c").distinct().withColumn("run", F.col("c") - F.row_number().over(along))
    return own.groupBy(*keys, "r", "run").agg(F.min("c").alias("x1"), F.col("r").alias("y1"), (F.max("c") + 1).alias("x2"), (F.col("r") + 1).alias("y2")).drop("r", "run")


def merged_predictions(hot: DataFrame, part: str, least_pixels: float = 0, block: int = 256) -> tuple[DataFrame, DataFrame]:
    """Hot pixels (part, r, c, p) of all tiles and dates as components of their union.

    Returns comp, mean_prob and n_pixels of those of ``least_pixels`` or more, and their runs (comp and boxes of one-metre pixels).
    Components of each part have the mean of their pixels; the mean of a union is that of the parts' components in it. ``part`` is a small integer;
    rows and columns are within four million of 0.
    """
    place = lambda c: (F.col(c) + (1 << 22)).cast("long")
    at = F.shiftleft(place("r"), 23) + place("c")
    own = hot.groupBy(part, "r", "c").agg(F.max("p").alias("p"))
    each = pixel_components(own.withColumn("id", F.shiftleft(F.col(part).cast("long"), 46) + at), block, [part]).select("r", "c", "p", F.col("comp").alias("own"))
    each = written(each, "hot")
    whole = pixel_components(each.select("r", "c").distinct().withColumn("id", at), block).select("r", "c", "comp")
    both = written(each.join(whole, ["r", "c"]), "hot")
    parts = both.groupBy("comp", "own").agg(F.avg("p").alias("mean"))
    sizes = both.select("comp", "r", "c").distinct().groupBy("comp").agg(F.count("*").alias("n_pixels")).where(F.col("n_pixels") >= least_pixels)
    merged = parts.groupBy("comp").agg(F.avg("mean").alias("mean_prob")).join(sizes, "comp")
    return merged, pixel_runs(both.join(merged.select("comp"), "comp", "left_semi"), ["comp"])


def score_windows(pixels: DataFrame, chosen: DataFrame, patch: int, scorer, bands: list[str], keys: list[str] = (), most_nodata: float | None = None) -> DataFrame:
    """Probability of each pixel in the chosen windows: keys, r, c, prob.

    ``scorer`` maps an array (n, bands) of reflectances in 0..1 to probabilities; the windows are a semi-join
    below it, so nothing else is scored. A window of which more than ``most_nodata`` has no data (pixel absent, or all bands 0) is not scored.
    """
    keyed = pixels.withColumn("row", (F.floor(F.col("r") / patch) * patch).cast("bigint")).withColumn("col", (F.floor(F.col("c") / patch) * patch).cast("bigint"))
    chosen = chosen.select(*keys, "row", "col")
    if most_nodata is not None:
        seen = keyed.join(chosen, [*keys, "row", "col"], "left_semi").groupBy(*keys, "row", "col").agg(F.count_if(F.greatest(*[F.col(b) for b in bands], F.lit(0)) > 0).alias("n"))
        chosen = seen.where(1 - F.col("n") / float(patch * patch) <= most_nodata).select(*keys, "row", "col")
    own = keyed.join(chosen, [*keys, "row", "col"], "left_semi").select(*keys, "r", "c", *bands)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = np.clip(pdf[bands].to_numpy(float) / 10_000, 0, 1)
            yield pdf[[*keys, "r", "c"]].assign(prob=scorer(x))

    named = ", ".join(f"{k} {dict(own.dtypes)[k]}" for k in keys)
    return own.mapInPandas(run, f"{named + ', ' if keys else ''}r long, c long, prob double")
