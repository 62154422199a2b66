"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text gives each document a perplexity.

The model is of characters, five at a time, from a vocabulary of the corpus's own: the 4094 most frequent
characters, and one more for all others. Counts cover all text that the model is trained on and live in tables dealt by
n-gram (sharded); nothing of the corpus is sampled, and only the vocabulary is broadcast.

1. Documents are packed into compressed chunks, bucketed by chunk in the shared folder.
2. The training documents' n-grams are counted; from them come the continuation counts of lower orders,
   three discounts for each order, and for every seen n-gram and context its discounted share and back-off weight.
3. Each chunk asks for its distinct n-grams once. The distinct questions are joined with the count
   tables, order by order; answers return to their chunk, where documents are scored.
4. One part in eight of the trusted documents (by a hash of their id) is held out of the counts. A document is kept if
   its perplexity is no higher than a quantile of its language's held-out documents, which the model has not seen either.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pvscan.llm import textgrams
from pvscan.scratch import discard, remove, scratch_path, written

#: Characters of an n-gram, bits of a character in a packed one, and characters that the vocabulary tells apart.
ORDER, BITS = 5, 12
KNOWN = (1 << BITS) - 2
#: Bytes of text in a chunk (or one document), and characters scored at once.
CHUNK, STEP = 32 << 20, 1 << 20
#: How hard chunks are compressed; they are written once and read three times.
LEVEL = 6
#: One part of so many of the trusted documents sets the thresholds.
FOLDS = 8
_CHUNKS = "chunk long, ids array<long>, langs array<string>, sizes array<long>, blob binary"
_PACKED = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())), ("blob", pa.binary())])


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId(), 0
    ids, langs, sizes, blobs, held, packer = [], [], [], [], 0, zstandard.ZstdCompressor(level=LEVEL).compressobj()
    for batch in batches:
        for own in textgrams.slabs(batch, "text"):
            raw, offsets = textgrams.utf8(own.column(2))
            blobs.append(packer.compress(raw.tobytes()))
            ids += own.column(0).to_pylist()
            langs += own.column(1).to_pylist()
            sizes += np.diff(offsets).tolist()
            held += len(raw)
            if held >= CHUNK:
                yield _chunk(part << 32 | k, ids, langs, sizes, [*blobs, packer.flush()])
                ids, langs, sizes, blobs, held, packer, k = [], [], [], [], 0, zstandard.ZstdCompressor(level=LEVEL).compressobj(), k + 1
    if ids:
        yield _chunk(part << 32 | k, ids, langs, sizes, [*blobs, packer.flush()])


def _chunk(name: int, ids: list, langs: list, sizes: list, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"chunk": [name], "ids": [ids], "langs": [langs], "sizes": [sizes], "blob": [b"".join(blobs)]}, _PACKED)


def _bucketed(chunks: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """Written once, so that every reader sees the same chunks, and read without a shuffle by chunk; and what deletes them."""
    spark = chunks.sparkSession
    name, path = f"pvscan_{uuid.uuid4().hex}", scratch_path(spark, "chunks")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks.write.bucketBy(n, "chunk").option("path", path).saveAsTable(name)

    def drop() -> None:
        spark.sql(f"drop table if exists {name}")
        remove(spark, path)

    return spark.table(name), drop


def _points(raw: np.ndarray) -> np.ndarray:
    return np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _tallying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each code point occurs."""
    counts = np.zeros(0x110000, np.int64)
    for batch in batches:
        for part in textgrams.slabs(batch, "text"):
            own = np.bincount(_points(textgrams.utf8(part.column(part.schema.get_field_index("text")))[0]))
            counts[: len(own)] += own
    seen = np.flatnonzero(counts)
    if len(seen):
        yield pa.RecordBatch.from_pydict({"point": seen, "n": counts[seen]})


def vocabulary(texts: DataFrame) -> np.ndarray:
    """Each code point's number: from 1 for the most frequent KNOWN ones, and one number for all others. ``texts`` has one column, text."""
    counts = texts.mapInArrow(_tallying, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    points = [r[0] for r in counts.orderBy(F.desc("n"), "point").limit(KNOWN).collect()]
    table = np.full(0x110000, KNOWN + 1, np.uint16)
    table[points] = np.arange(1, len(points) + 1)
    return table


def codes(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each character's n-gram as a packed integer, and each text's first. Texts begin with zeros."""
    points = table[_points(raw)].astype(np.int64)
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=begins[1:])
    first = begins[offsets]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    at = np.arange(len(points)) + (ORDER - 1) * (doc + 1)
    padded = np.zeros(len(points) + (ORDER - 1) * (len(offsets) - 1), np.int64)
    padded[at] = points
    grams = np.zeros(len(points), np.int64)
    for k in range(ORDER):
        grams |= padded[at - k] << BITS * k
    return grams, first


def _steps(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    part = np.cumsum(sizes) // STEP
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b)


def _unpacked(batch: pa.RecordBatch | pa.Table, i: int, table: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [a, b) of a chunk, their n-grams, and each one's first."""
    sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(batch.column("blob")[i].as_py()), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in _steps(sizes):
        yield (a, b, *codes(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], table))


def _asking(table) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                found = np.empty(0, np.int64)
                for _, _, grams, _ in _unpacked(batch, i, table.value):
                    found = np.union1d(found, pd.unique(grams))
                if len(found):
                    yield pa.RecordBatch.from_pydict({"chunk": np.full(len(found), batch.column("chunk")[i].as_py()), "gram": found})
                textgrams.give_back()

    return run


def _counting(table) -> Callable:
    """Counts of the n-grams of the documents whose ids are listed in ``trusted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                trusted = set(batch.column("trusted")[i].as_py())
                ids = batch.column("ids")[i].as_py()
                gram, n = np.empty(0, np.int64), np.empty(0, np.int64)
                for a, b, grams, first in _unpacked(batch, i, table.value):
                    own = np.repeat(np.array([x in trusted for x in ids[a:b]], bool), np.diff(first))
                    new, times = np.unique(grams[own], return_counts=True)
                    gram, code = np.unique(np.concatenate([gram, new]), return_inverse=True)
                    n = np.bincount(code, np.concatenate([n, times]), len(gram)).astype(np.int64)
                if len(gram):
                    yield pa.RecordBatch.from_pydict({"gram": gram, "n": n})
                textgrams.give_back()

    return run


_SCORED = "doc_id long, lang string, n_chars long, logp double"


def _scoring(table) -> Callable:
    """A chunk's documents, from the answers to it."""

    def run(answers: pa.Table, chunk: pa.Table) -> pa.Table:
        known, logp = answers.column("gram").to_numpy(), answers.column("logp").to_numpy()
        order = np.argsort(known)
        known, logp = known[order], logp[order]
        parts = []
        for i in range(len(chunk)):
            ids, langs = chunk.column("ids")[i].as_py(), chunk.column("langs")[i].as_py()
            for a, b, grams, first in _unpacked(chunk, i, table.value):
                code, distinct = pd.factorize(grams)
                each = logp[np.searchsorted(known, distinct)][code] if len(distinct) else np.empty(0)
                n = np.diff(first)
                total = np.bincount(np.repeat(np.arange(len(n)), n), each, len(n))
                parts.append(pa.table([pa.array(ids[a:b], pa.int64()), pa.array(langs[a:b], pa.string()), pa.array(n, pa.int64()), pa.array(total, pa.float64())], ["doc_id", "lang", "n_chars", "logp"]))
        textgrams.give_back()
        return pa.concat_tables(parts) if parts else pa.table({"doc_id": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "n_chars": pa.array([], pa.int64()), "logp": pa.array([], pa.float64())})

    return run


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Those of counts 1, 2 and 3 or more, from how many n-grams occur 1 to 4 times; halves where too few do."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.0), float(k)) if x > 0 else 0.5 * k for k, x in enumerate(d, 1))


def _mask(order: int) -> int:
    return (1 << BITS * order) - 1


def _suffix(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit(_mask(order)))


def tables(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame], float]:
    """From highest-order counts (gram, n): for orders ORDER to 1, (key, share) of n-grams and (key, back) of contexts, and the chance of any character.

    ``share`` is the discounted part, ``back`` the weight of the next lower order. The context of order 1 is 0.
    """
    shares, backs = [], []
    at = counts
    size = 0
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            at = written(at.groupBy(F.col("gram").bitwiseAND(F.lit(_mask(order))).alias("gram")).agg(F.count("*").alias("n")), "order")
        tally = at.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)], F.count("*")).first()
        d1, d2, d3 = discounts(list(tally[:4]))
        size = tally[4]
        context = F.shiftrightunsigned("gram", BITS)
        sums = at.groupBy(context.alias("key")).agg(F.sum("n").alias("all"), *[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2)], F.count_if(F.col("n") > 2).alias("n3"))
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        shares.append(at.withColumn("key", context).join(sums, "key").select(F.col("gram").alias("key"), ((F.col("n") - off) / F.col("all")).alias("share")))
        backs.append(sums.select("key", ((d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("all")).alias("back")))
    return shares, backs, 1.0 / (size + 1)


def probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``gram`` and the log of its last character's probability after those before it, by joins with the count tables."""
    shares, backs, floor = tables(counts)
    own = grams
    for order, share, back in zip(range(ORDER, 0, -1), shares, backs, strict=True):
        key = _suffix(F.col("gram"), order)
        own = own.withColumn("key", key).join(share.withColumnRenamed("share", f"s{order}"), "key", "left")
        own = own.withColumn("key", F.shiftrightunsigned(key, BITS)).join(back.withColumnRenamed("back", f"b{order}"), "key", "left").drop("key")
    p: Column = F.lit(floor)
    for order in range(1, ORDER + 1):
        p = F.coalesce(f"s{order}", F.lit(0.0)) + F.coalesce(f"b{order}", F.lit(1.0)) * p
    return own.select("gram", F.log(p).cast("float").alias("logp"))


def perplexities(docs: DataFrame, trusted: DataFrame, identifier: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """``doc_id``, lang, n_chars, logp and perplexity of every row of ``docs``, by a model of those whose ids ``trusted`` lists.

    Null and empty texts have no perplexity (null). Trusted ids that are null or repeated count for nothing
    or once; all rows of a trusted id are trusted. Without trusted text every character has the same chance.
    Columns other than the three named are not read, whatever their names. No documents: no rows.
    """
    spark = textgrams.small_batches(docs.sparkSession)
    own = docs.select(F.col(identifier).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    table = spark.sparkContext.broadcast(vocabulary(own.select("text")))  # 2 MB
    chunks, drop = _bucketed(own.mapInArrow(_packing, _CHUNKS))
    good = trusted.select(F.col(identifier).cast("long").alias("id")).where("id is not null").distinct()
    listed = chunks.select("chunk", F.explode("ids").alias("id")).join(good, "id").groupBy("chunk").agg(F.collect_set("id").alias("trusted"))
    counts = written(chunks.join(listed, "chunk").mapInArrow(_counting(table), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    asked = written(chunks.select("chunk", "sizes", "blob").mapInArrow(_asking(table), "chunk long, gram long"), "asked")
    known = probabilities(asked.select("gram").distinct(), counts)
    answers = asked.join(known, "gram").select("chunk", "gram", "logp")
    scored = written(answers.groupBy("chunk").cogroup(chunks.groupBy("chunk")).applyInArrow(_scoring(table), _SCORED), "scored")
    discard(counts, asked)
    drop()
    return scored.withColumn("perplexity", F.when(F.col("n_chars") > 0, F.exp(-F.col("logp") / F.col("n_chars"))))


def held_out(identifier: Column) -> Column:
    """Whether a trusted document sets the thresholds instead of training the model."""
    return F.pmod(F.xxhash64(F.lit("fold"), identifier.cast("long")), F.lit(FOLDS)) == 0


def classify(docs: DataFrame, labels: DataFrame, quality: str = "quality", quantile: float = 0.995, identifier: str = "doc_id", least: int = 20, **columns) -> DataFrame:
    """``perplexities`` with threshold and keep.

    Trusted are the documents with a label of 1 or more in ``quality``; those that are not held out train the model. The threshold is
    the quantile of the language's held-out documents; of all held-out ones, for a language with fewer than ``least``; of all trusted ones,
    if fewer are held out in all. Null languages are one language. Without trusted text all documents with text are kept. Texts without
    characters are not kept. Repeated rows are judged alike. No documents: no rows.
    """
    good = labels.where(F.col(quality) >= 1).select(F.col(identifier).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    scored = perplexities(docs, good.where(~held_out(F.col("doc_id"))).withColumnRenamed("doc_id", identifier), identifier, **columns)
    own = scored.join(good, "doc_id", "left_semi").where("n_chars > 0").select(F.coalesce("lang", F.lit("")).alias("l"), "perplexity", held_out(F.col("doc_id")).alias("held"))
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("threshold")
    by = own.where("held").groupBy("l").agg(at, F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
    pooled = own.where("held").agg(at, F.count("*")).first()
    overall = pooled[0] if pooled[1] >= least else own.agg(at).first()[0]
    out = scored.withColumn("l", F.coalesce("lang", F.lit(""))).join(by, "l", "left").drop("l")
    out = out.withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
    return out.withColumn("keep", (F.col("n_chars") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    out = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "lang", "n_chars", "perplexity", "threshold", "keep")
