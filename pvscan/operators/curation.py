"""Chips and their curation: splits, negative samples, cleaning, the merged pool, the screening head."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from pvscan.functions.geo import block_id


def split_sizes(n: int, train: float, val: float) -> tuple[int, int]:
    """Blocks of train and of validation: at least one each, halves rounded to even; two blocks or fewer leave no test."""
    if n <= 2:
        return min(1, n), max(0, n - 1)
    return max(1, round(n * train)), max(1, round(n * val))


def split_blocks(blocks: list[int], train: float, val: float, seed: int) -> dict[int, str]:
    """Each distinct block's split after a seeded shuffle of the sorted blocks."""
    own = np.array(sorted(set(blocks)), dtype=np.int64)
    np.random.default_rng(seed).shuffle(own)
    a, b = split_sizes(len(own), train, val)
    return {int(x): "train" if i < a else "val" if i < a + b else "test" for i, x in enumerate(own)}


#: Modulus of the order of blocks; a prime other than the factor in their ids.
_BLOCKS = (1 << 31) - 1


def block_order(block: Column, seed: int) -> Column:
    """A documented arithmetic shuffle of blocks: the same in any engine."""
    return F.pmod(block * 48271 + F.lit(seed * 104_729), F.lit(_BLOCKS))


def assign_splits(chips: DataFrame, x: Column, y: Column, km: float, train: float = 0.7, val: float = 0.15, seed: int = 42, order: str = "hashed") -> DataFrame:
    """``chips`` with block and split: spatial blocks of ``km`` are never divided.

    ``hashed`` takes blocks in the arithmetic order and numbers them by ranges, so there may be any number of them. ``shuffled`` takes numpy's seeded
    permutation, which needs them on the driver: a block of 25 km is one of fewer than a million on Earth.
    """
    own = chips.withColumn("block", block_id(x, y, km))
    blocks = own.select("block").distinct()
    if order == "shuffled":
        table = own.sparkSession.createDataFrame(sorted(split_blocks([r[0] for r in blocks.collect()], train, val, seed).items()), "block long, split string")
        return own.join(table, "block")
    if order != "hashed":
        raise ValueError(f"unknown order {order!r}")
    from pvscan.operators.labels import with_building_id

    placed = with_building_id(blocks.withColumn("at", block_order(F.col("block"), seed)), ["at", "block"])
    a, b = split_sizes(placed.count(), train, val)
    k = F.col("building_id")
    table = placed.select("block", F.when(k < a, "train").when(k < a + b, "val").otherwise("test").alias("split"))
    return own.join(table, "block")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value of a column occurs, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def all_in(few: DataFrame, many: DataFrame, key: str) -> bool:
    """Whether every value of ``key`` in ``few`` is in ``many``."""
    return few.select(key).distinct().join(many.select(key).distinct(), key, "left_anti").isEmpty()


def hashed_order(key: Column, seed: int) -> Column:
    """A documented arithmetic shuffle: the same in any engine."""
    return F.pmod(key * 7919 + F.lit(seed * 104_729), F.lit(1_000_003))


def sample_negatives(negatives: DataFrame, target: int, key: str, seed: int) -> DataFrame:
    """Exactly ``target`` rows in the seeded order, or all if there are no more (the sample is the feature)."""
    return negatives.orderBy(hashed_order(F.col(key), seed), key).limit(target)


def prediction_share(pixels: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Share of each chip's pixels at or above the threshold."""
    return pixels.groupBy(*keys).agg(F.avg(F.when(F.col("p") >= threshold, 1.0).otherwise(0.0)).alias("share"))


def clean_negatives(index: DataFrame, shares: DataFrame, key: str, most: float) -> DataFrame:
    """Marks negatives whose share is ``most`` or more; all marks are made anew, so a second run changes nothing."""
    own = index.drop("cleaned_out").join(shares, key, "left")
    return own.withColumn("cleaned_out", (F.col("kind") == "neg") & F.coalesce(F.col("share") >= most, F.lit(False)))


def drop_cleaned_out(index: DataFrame) -> DataFrame:
    """Without marked rows; null marks and a missing column keep rows."""
    if "cleaned_out" not in index.columns:
        return index
    return index.where(~F.coalesce("cleaned_out", F.lit(False)))


def chip_pool(regions: dict[str, DataFrame], channels: int | None = None) -> DataFrame:
    """Regions' chip indexes in one table with region; marked chips are left out, and a packed file's row numbers (h5_row) stay as they were given before.

    A region without an index (None) or with another number of channels raises ValueError.
    """
    pool = None
    for region, index in regions.items():
        if index is None:
            raise ValueError(f"region {region!r} has no chip index")
        if channels is not None and "channels" in index.columns and not index.where(F.col("channels") != channels).isEmpty():
            raise ValueError(f"region {region!r} has chips with other than {channels} channels")
        own = drop_cleaned_out(index.withColumn("region", F.lit(region)))
        pool = own if pool is None else pool.unionByName(own, allowMissingColumns=True)
    if pool is None:
        raise ValueError("no regions")
    return pool


def split_of(pool: DataFrame, split: str, primary: str) -> DataFrame:
    """Rows of a split; the test split is the primary region's, or its validation rows if it has none."""
    if split != "test":
        return pool.where(F.col("split") == split)
    own = pool.where((F.col("region") == primary) & (F.col("split") == "test"))
    return pool.where((F.col("region") == primary) & (F.col("split") == "val")) if own.isEmpty() else own


def standardisation(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """For each dimension: mean and population standard deviation plus 1e-6."""
    each = embeddings.select(F.posexplode(column).alias("dim", "v"))
    v = F.col("v").cast("double")
    return each.groupBy("dim").agg(F.avg(v).alias("mean"), (F.stddev_pop(v) + 1e-6).alias("std"))


def class_weight(embeddings: DataFrame, positive: str) -> DataFrame:
    """max(1, negatives / max(1, positives)), with both counts."""
    own = embeddings.agg(F.count_if(F.col(positive)).alias("n_pos"), F.count_if(~F.col(positive)).alias("n_neg"))
    return own.withColumn("weight", F.greatest(F.lit(1.0), F.col("n_neg") / F.greatest(F.lit(1), F.col("n_pos"))))


def head_score(embedding: Column, mean: list[float], std: list[float], weights: list[float], bias: float) -> Column:
    """Probability of the logistic head over standardised embeddings, summed in order of dimension."""
    as_array = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    centred = F.zip_with(embedding, as_array(mean), lambda e, m: e.cast("double") - m)
    scaled = F.zip_with(centred, as_array(std), lambda e, s: e / s)
    z = F.aggregate(F.zip_with(scaled, as_array(weights), lambda e, w: e * w), F.lit(0.0), lambda s, x: s + x) + F.lit(float(bias))
    return 1.0 / (1.0 + F.exp(-z))


def fit_head(embeddings: DataFrame, positive: str, column: str = "embedding", steps: int = 200):
    """A class-weighted logistic regression over standardised embeddings; returns the fitted model of pyspark.ml."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    weight = class_weight(embeddings, positive).first()["weight"]
    own = embeddings.select(array_to_vector(F.col(column).cast("array<double>")).alias("features"), F.col(positive).cast("double").alias("label"), F.when(F.col(positive), float(weight)).otherwise(1.0).alias("w"))
    return LogisticRegression(weightCol="w", standardization=True, maxIter=steps, regParam=1e-3).fit(own)


def stride(patch: int, fraction: float) -> int:
    return max(1, round(patch * fraction))


def jittered_corner(row: Column, col: Column, patch: int, name: Column, seed: int) -> tuple[Column, Column]:
    """Upper left pixel of a window around a point, moved by up to a quarter of its side, by a hash of the chip's name."""
    reach = patch // 4
    by = lambda axis: F.pmod(F.xxhash64(F.lit(seed), name, F.lit(axis)), F.lit(2 * reach + 1)) - reach
    corner = lambda at, axis: (F.floor(at) + by(axis) - patch // 2).cast("bigint")
    return corner(row, 0), corner(col, 1)


def pooled(pixels: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Each window's embedding by global average pooling: the mean of each channel over its pixels."""
    return pixels.groupBy(*keys).agg(F.array(*[F.avg(F.col(b).cast("double")) for b in bands]).alias("embedding"))


def sliding(pixels: DataFrame, keys: list[str], patch: int, step: int) -> DataFrame:
    """``pixels`` with row and col of each window of ``patch`` pixels, one every ``step``, that holds them: a pixel is repeated for each."""
    span = lambda c: F.sequence(F.greatest(F.ceil((F.col(c) - patch + 1) / step), F.lit(0)), F.floor(F.col(c) / step))
    own = pixels.withColumn("row", F.explode(span("r"))).withColumn("col", F.explode(span("c")))
    return own.withColumn("row", (F.col("row") * step).cast("bigint")).withColumn("col", (F.col("col") * step).cast("bigint"))


def augmented(image: np.ndarray, mask: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Random flips and quarter turns of an image (bands, rows, columns) and its mask alike."""
    for axis in (-1, -2):
        if rng.random() < 0.5:
            image, mask = np.flip(image, axis), np.flip(mask, axis)
    k = int(rng.integers(0, 4))
    return np.rot90(image, k, (-2, -1)).copy(), np.rot90(mask, k, (-2, -1)).copy()
