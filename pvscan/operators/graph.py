"""Connected components of an edge table by contraction, with a local end.

Each round every node points to that one among itself and its neighbours whose hash is least, and the edges are
drawn anew between the nodes pointed to. A component that has shrunk to one node leaves the table, and of a
long path about half of the nodes go in each round, so tables shrink geometrically. Once no more than
``local`` edges are left (they are counted), one task finishes them with a union-find on arrays; until then
everything is an aggregation with a map-side part or a join that Spark splits where a node has very many edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pvscan.scratch import discard, written

#: Edges that one task finishes: 16 bytes each, and some ten times that while it works.
LOCAL = 1 << 20


def components(edges: DataFrame, a: str = "a", b: str = "b", local: int = LOCAL) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for every node of an edge; loops and repeats don't matter.

    Nodes are integers; an edge with a null end is ignored. No edges: no rows. Each round is one pair of tables in the shared folder, so a lost
    executor repeats a round at most; tables of rounds are deleted before the result is returned.
    """
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(F.col(a) != F.col(b)).distinct()
    now, n = _counted(pairs, "edges")
    rounds: list[DataFrame] = []
    while n > local:
        parents = written(_parents(now), "parents")
        ends = [parents.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}")) for c in "uv"]
        up_u, up_v = F.col("up_u"), F.col("up_v")
        drawn = now.join(ends[0], "u").join(ends[1], "v").where(up_u != up_v).select(F.greatest(up_u, up_v).alias("u"), F.least(up_u, up_v).alias("v")).distinct()
        rounds.append(parents)
        after, n = _counted(drawn, "edges")
        discard(now)
        now = after
    out = written(now.coalesce(1).mapInArrow(_united, "node long, root long"), "roots")
    discard(now)
    if not rounds:
        return out
    labels = out
    for parents in reversed(rounds):
        labels = parents.join(labels.withColumnRenamed("node", "up"), "up", "left").select("node", F.coalesce("root", "up").alias("root"))
    least = labels.groupBy("root").agg(F.min("node").alias("least"))
    named = written(labels.join(least, "root").select("node", F.col("least").alias("root")), "roots")
    discard(out, *rounds)
    return named


def _parents(edges: DataFrame) -> DataFrame:
    """node and up: of each node and its neighbours the one of the least hash."""
    both = edges.union(edges.select("v", "u")).toDF("node", "near")
    least = both.groupBy("node").agg(F.min_by("near", F.xxhash64("near")).alias("near"), F.min(F.xxhash64("near")).alias("h"))
    return least.select("node", F.when(F.col("h") < F.xxhash64("node"), F.col("near")).otherwise(F.col("node")).alias("up"))


def _counted(pairs: DataFrame, name: str) -> tuple[DataFrame, int]:
    table = written(pairs, name)
    return table, table.count()  # from the files' footers


def united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, sorted, and the least node that each reaches."""
    names, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = code[: len(a)], code[len(a) :]
    up = np.arange(len(names))
    while len(a):
        a, b = up[a], up[b]
        open_ = a != b
        a, b = a[open_], b[open_]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up[up] != up).any():
            up = up[up]
    return names, names[up]


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if parts:
        node, root = united(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_pydict({"node": node, "root": root})
