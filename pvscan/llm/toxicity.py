"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

``P(grade <= k) = sigmoid(theta_k - w.x)``: one weight for each feature, shared by all ordered
thresholds theta. Features are the distinct words of a text (ASCII letters lower-cased) and their beginnings, by hash.
The model is fitted on a bounded sample of labelled rows, with the features that go with the grade in it, and
then scores every text; the expected grade is its severity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from pvscan.llm import textgrams

#: Labelled rows that the model is fitted on at most: those of the least seeded hash.
SAMPLE = 20_000
#: Features kept at most, and how many standard errors the mean grade of their texts is off at least.
FEATURES, ERRORS = 50_000, 3.5
#: Bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (5, 6, 8, 10)


@dataclass(frozen=True)
class Model:
    """features: sorted hashes; weights: of each; thresholds: ascending, one fewer than grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    grades: int


def distinct_features(column: pa.Array, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) pairs, each once; ``among``: only these sorted features, by their place in it."""
    w = textgrams.words(column, textgrams.ALNUM)
    of = np.repeat(np.arange(len(w.first) - 1, dtype=np.int32), np.diff(w.first))
    docs, features = [], []
    for size in (None, *BEGINNINGS):
        own = np.ones(len(of), bool) if size is None else w.end - w.start > size
        feature = w.hash if size is None else textgrams.mix(textgrams.span_hashes(w.raw, w.start[own], w.start[own] + size) + np.uint64(size))
        doc = of[own]
        if among is not None:
            at = np.minimum(np.searchsorted(among, feature), len(among) - 1)
            known = among[at] == feature
            doc, feature = doc[known], at[known]
        docs.append(doc)
        features.append(feature)
    doc, feature = np.concatenate(docs), np.concatenate(features)
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[new], feature[new]


def fit_ordinal(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, grades: int, least: int = 3, most: int = FEATURES, l2: float = 0.3, steps: int = 400, rate: float = 0.1) -> Model:
    """Penalised maximum likelihood by Adam on all rows; ``doc`` and ``feature`` are pairs, ``grade`` is by document.

    Features in fewer than ``least`` documents are left out. With fewer than two grades, or no rows, nothing is fitted.
    """
    empty = Model(np.empty(0, np.uint64), np.empty(0), np.zeros(0), 1)
    if grades < 2 or not len(grade):
        return empty
    names, code, count = np.unique(feature, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(count >= least)
    if len(kept) > most:
        kept = np.sort(kept[np.argsort(-count[kept], kind="stable")[:most]])
    to = np.full(len(names), -1)
    to[kept] = np.arange(len(kept))
    own = to[code] >= 0
    d, f = doc[own], to[code[own]]
    n, m = len(grade), len(kept)
    # thresholds at the grades' own frequencies; gaps between them stay positive as exponentials
    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / n, 1e-4, 1 - 1e-4)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    w, a, gaps = np.zeros(m), theta[0], np.log(np.maximum(np.diff(theta), 1e-3))
    p = np.concatenate([w, [a], gaps])
    mean, var = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, steps + 1):
        w, theta = p[:m], p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1 :]))])
        score = np.bincount(d, w[f], n)
        cum = np.concatenate([np.zeros((n, 1)), sigmoid(theta[None, :] - score[:, None]), np.ones((n, 1))], 1)
        slope = cum * (1 - cum)
        row = np.arange(n)
        prob = np.maximum(cum[row, grade + 1] - cum[row, grade], 1e-12)
        by_score = (slope[row, grade + 1] - slope[row, grade]) / prob  # derivative of the loss by the score
        by_theta = np.zeros(grades - 1)
        for k in range(grades - 1):
            by_theta[k] = -(slope[grade == k, k + 1] / prob[grade == k]).sum() + (slope[grade == k + 1, k + 1] / prob[grade == k + 1]).sum()
        tails = np.cumsum(by_theta[::-1])[::-1]
        g = np.concatenate([np.bincount(f, by_score[d], m) + l2 * w, [tails[0]], tails[1:] * np.exp(p[m + 1 :])]) / n
        mean, var = 0.9 * mean + 0.1 * g, 0.999 * var + 0.001 * g * g
        p = p - rate * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.999**t)) + 1e-9)
    theta = p[m] + np.concatenate([[0.0], np.cumsum(np.exp(p[m + 1 :]))])
    return Model(names[kept], p[:m], theta, grades)


def severities(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and most probable grade of each text."""
    n = len(column)
    if model.grades < 2:
        return np.zeros(n), np.zeros(n, np.int32)
    score = np.zeros(n)
    if len(model.features):
        doc, at = distinct_features(column, model.features)
        score = np.bincount(doc, model.weights[at], n)
    below = 1 / (1 + np.exp(-np.clip(model.thresholds[None, :] - score[:, None], -40, 40)))
    prob = np.diff(np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], 1), axis=1)
    return (1 - below).sum(1), prob.argmax(1).astype(np.int32)


def fit(docs: DataFrame, labels: DataFrame, grade: str = "toxic", identifier: str = "doc_id", text: str = "text", sample: int = SAMPLE, seed: int = 0) -> Model:
    """Fits on at most ``sample`` labelled documents; of rows that share an id the first in order of text counts.

    Labels with a null id or grade, or a negative grade, are ignored; of several labels of a document the highest
    counts. Grades are 0 to the highest in the sample. With fewer than two different grades nothing is fitted,
    and every text gets 0.
    """
    textgrams.small_batches(docs.sparkSession)
    own = labels.where(F.col(identifier).isNotNull() & (F.col(grade) >= 0)).groupBy(F.col(identifier).alias("__id")).agg(F.max(grade).cast("int").alias("__grade"))
    own = own.orderBy(F.xxhash64(F.lit(seed), "__id"), "__id").limit(sample)
    met = docs.select(F.col(identifier).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(own), "__id")
    met = met.groupBy("__id", "__grade").agg(F.min("__text").alias("__text")).select("__grade", "__text")  # one row of those that share an id

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textgrams.slabs(batch, "__text"):
                doc, feature = distinct_features(part.column(1))
                grades = part.column(0).to_numpy().astype(float)
                name, code = np.unique(feature, return_inverse=True)
                yield pa.RecordBatch.from_pydict({"feature": name.view(np.int64), "n": np.bincount(code, minlength=len(name)), "s": np.bincount(code, grades[doc], len(name))})

    m = met.agg(F.count("*").alias("n"), F.avg("__grade").alias("mean"), F.var_pop("__grade").alias("variance"), F.max("__grade").alias("top")).first()
    if not m["variance"]:
        return fit_ordinal(np.empty(0, int), np.empty(0, np.uint64), np.empty(0, int), 0)
    counts = met.mapInArrow(tally, "feature long, n long, s double").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where("n >= 3")
    off = (F.col("s") - m["mean"] * F.col("n")) / F.sqrt(m["variance"] * F.col("n"))
    listed = counts.withColumn("off", F.abs(off)).where(F.col("off") >= ERRORS).orderBy(F.desc("off"), "feature").limit(FEATURES).toArrow()
    chosen = np.sort(listed.column("feature").to_numpy().view(np.uint64))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textgrams.slabs(batch, "__text"):
                doc, at = distinct_features(part.column(1), chosen) if len(chosen) else (np.empty(0, int), np.empty(0, int))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(part) + 1)), pa.int32()), pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["grade", "features"])

    rows = met.mapInArrow(features, "grade int, features array<int>").toArrow().combine_chunks()
    lists = rows.column(1).combine_chunks()
    grades = rows.column(0).to_numpy().astype(int)
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return fit_ordinal(doc, chosen[lists.values.to_numpy()], grades, int(grades.max()) + 1)


def score(docs: DataFrame, model: Model, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or those of its columns that are named) with severity (expected grade) and grade (most probable).

    Null and empty texts have no features and get the thresholds' own prediction. Columns named severity or
    grade are replaced, others pass through. Repeated rows get equal scores. A model without grades gives 0.
    """
    docs = docs.drop("severity", "grade")
    shared = textgrams.small_batches(docs.sparkSession).sparkContext.broadcast(model)  # at most FEATURES weights
    kept = docs.columns if columns is None else columns
    schema = StructType([*(docs.schema[c] for c in kept), StructField("severity", DoubleType()), StructField("grade", IntegerType())])
    return docs.mapInArrow(_scoring(shared, text, kept), schema)


def _scoring(shared, text: str, kept: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textgrams.slabs(batch, text):
                severity, grade = severities(shared.value, part.column(part.schema.get_field_index(text)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(severity), pa.array(grade)], [*kept, "severity", "grade"])

    return run


def is_toxic(severity, at: float = 0.5):
    """An expected grade that rounds to 1 or more."""
    return severity >= at


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, columns=["doc_id"]).select("doc_id", "severity", "grade", is_toxic(F.col("severity")).alias("toxic"))
