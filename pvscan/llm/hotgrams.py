"""Grams that very many rows hold: found without a shuffle of all grams, and few enough to broadcast.

A gram counts here where one task meets it twice or more among some millions of neighbouring ones; those
counts are summed. A gram in a fixed share of all documents is always found so. What is missed, or
lies beyond the bound, only costs time: callers give the same results for every list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pvscan.scratch import discard, written

#: Grams counted together in a task, grams listed at most (those that occur most), and how often a listed one occurs at least.
TOGETHER, MOST, LEAST = 2_000_000, 1 << 19, 32
#: Counts below this have a histogram step of their own; steps double beyond it.
_EXACT = 1024


def hot_grams(docs: DataFrame, grams: Callable[[pa.RecordBatch], Iterator[dict[str, np.ndarray]]], kinds: list[str], least: int = LEAST, most: int = MOST, counted: bool = False) -> dict:
    """Sorted hashes of the hot grams of each kind (``counted``: and how often each was counted); ``grams`` yields arrays of hashes by kind."""

    def flush(kind: str, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        name, count = np.unique(np.concatenate(parts), return_counts=True)
        more = count > 1
        if more.any():
            yield pa.RecordBatch.from_pydict({"kind": [kind] * int(more.sum()), "hash": name[more].view(np.int64), "n": count[more]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {k: [] for k in kinds}
        for batch in batches:
            for got in grams(batch):
                for kind, hashes in got.items():
                    held[kind].append(hashes)
                    if sum(map(len, held[kind])) >= TOGETHER:
                        yield from flush(kind, held[kind])
                        held[kind] = []
        for kind, parts in held.items():
            if parts:
                yield from flush(kind, parts)

    counts = docs.mapInArrow(run, "kind string, hash long, n long").groupBy("kind", "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    counts = written(counts, "grams")
    # the least count at which the list has room for all, from a histogram of bounded size
    steps = F.when(F.col("n") < _EXACT, F.col("n")).otherwise(F.lit(_EXACT) * F.pow(F.lit(2.0), F.floor(F.log2(F.col("n") / _EXACT))).cast("long"))
    found, left = least, most
    for at, n in sorted(((r[0], r[1]) for r in counts.groupBy(steps.alias("at")).agg(F.count("*").alias("n")).collect()), reverse=True):
        left -= n
        if left < 0:
            found = at + 1 if at < _EXACT else 2 * at
            break
    rows = counts.where(F.col("n") >= found).toArrow()
    discard(counts)
    names, hashes, n = (rows.column(i).to_numpy() for i in range(3))
    out = {}
    for kind in kinds:
        own = names == kind
        name = hashes[own].view(np.uint64)
        order = np.argsort(name)
        out[kind] = (name[order], n[own][order]) if counted else name[order]
    return out


def among(listed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in the sorted list."""
    if not len(listed):
        return np.zeros(len(hashes), bool)
    return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes
