"""Substring dedup by seed and extend.

1. Seeds are winnowed anchors: of the five-word grams inside each 13-word window the one with the least
   hash. Equal windows have equal anchors, so documents that share a window meet in a join on anchors.
2. Each occurrence of a shared anchor goes, with up to eight words to either side, to the group of its anchor. There
   the earliest documents that hold one of its windows are looked up, and from the anchor the match with each is
   extended word by word to both sides, as far as the words agree (by 128 bits each).
3. Matches of 13 words or more are spans of the later document. Spans of neighbouring anchors that overlap or touch
   make its maximal repeats, which go.

What very many documents share never meets in one task. Exact copies of a text are found by their digest alone: all
but the earliest go as a whole and take no part in the groups. Windows that very many documents hold (a bounded list,
see ``hotgrams``) get their first document from one small aggregation and a broadcast. Anchors that very many hold count
as shared without a join, and their occurrences are dealt by window instead of by anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pvscan.llm import textgrams
from pvscan.llm.hotgrams import among, hot_grams

#: Words of a window (the least repeat) and of an anchor.
LENGTH, SEED = 13, 5
#: Occurrences of anchors that are held at once, and bytes of text that are cut at once.
HELD, SLAB = 1 << 17, 1 << 20
#: The end of a span that covers a whole text.
_ALL = 1 << 30


def _split(column: pa.Array, length: int, seed: int) -> tuple[textgrams.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, window starts, their hashes, and the hashes and places of their anchors."""
    w = textgrams.words(column, lower=False)
    at = np.flatnonzero(textgrams.has_gram(w.first, length))
    anchor, place = _anchors(textgrams.gram_hashes(w, seed), at, length - seed + 1)
    return w, at, textgrams.gram_hashes(w, length)[at], anchor, place


def _anchors(grams: np.ndarray, at: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
    """The least gram of each window, the rightmost of equal ones."""
    best, place = grams[at] if len(at) else np.empty(0, np.uint64), at.copy()
    for j in range(1, places):
        other = grams[at + j] if len(at) else best
        less = other <= best
        best = np.where(less, other, best)
        place[less] = at[less] + j
    return best, place


class _Plan:
    """What every task needs to know; broadcast. Listed windows with their first documents, and listed anchors."""

    def __init__(self, length: int, seed: int, windows: np.ndarray, first: np.ndarray, anchors: np.ndarray) -> None:
        self.length, self.seed, self.windows, self.first, self.anchors = length, seed, windows, first, anchors


def _doc_of(w: textgrams.Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(w.first, at, "right") - 1


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_valid().to_numpy(zero_copy_only=False)


def _first_docs(plan) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        first = np.full(len(p.windows), np.iinfo(np.int64).max)
        for batch in batches:
            for part in textgrams.slabs(batch, "text"):
                w = textgrams.words(part.column(1), lower=False)
                at = np.flatnonzero(textgrams.has_gram(w.first, p.length))
                hashes = textgrams.gram_hashes(w, p.length)[at]
                ids, known = _ids(part.column(0))
                doc = _doc_of(w, at)
                own = known[doc] & among(p.windows, hashes)
                np.minimum.at(first, np.searchsorted(p.windows, hashes[own]), ids[doc[own]])
        seen = np.flatnonzero(first < np.iinfo(np.int64).max)
        if len(seen):
            yield pa.RecordBatch.from_pydict({"k": seen, "first": first[seen]})

    return run


def _open(p: _Plan, w: textgrams.Words, at: np.ndarray, hashes: np.ndarray, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the documents, each window's document, and which windows the list doesn't settle."""
    ids, known = _ids(part.column(0))
    doc = _doc_of(w, at)
    return ids, doc, known[doc] & ~among(p.windows, hashes)


def _seeds(plan) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            for part in textgrams.slabs(batch, "text"):
                w, at, hashes, anchors, _ = _split(part.column(1), p.length, p.seed)
                ids, doc, own = _open(p, w, at, hashes, part)
                own &= ~among(p.anchors, anchors)
                doc, anchors = doc[own], anchors[own]
                order = np.lexsort((anchors, doc))
                doc, anchors = doc[order], anchors[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchors[1:] != anchors[:-1])
                if new.any():
                    yield pa.RecordBatch.from_pydict({"anchor": anchors[new].view(np.int64), "doc": ids[doc[new]]})

    return run


def _offsets(column: pa.ListArray) -> np.ndarray:
    """Where each row's values begin in the flat ones; a null list is empty."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _occurrences(plan) -> Callable:
    """Occurrences of shared anchors: group, document, key of its text, first word and words around, and the anchor's place in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        reach = p.length - p.seed
        for batch in batches:
            for part in textgrams.slabs(batch, "text", SLAB):
                w, at, hashes, anchors, places = _split(part.column(1), p.length, p.seed)
                ids, doc, own = _open(p, w, at, hashes, part)
                key = part.column(2).to_numpy()
                begin, shared = _offsets(part.column(3)), part.column(3).flatten().to_numpy(zero_copy_only=False)
                copy_at, copies = _offsets(part.column(4)), part.column(4).flatten().to_numpy(zero_copy_only=False)
                dealt = own & among(p.anchors, anchors)
                met = np.zeros(len(at), bool)
                edge = np.searchsorted(doc, np.arange(len(part) + 1))
                for d in np.flatnonzero(np.diff(begin) > 0):
                    mine = slice(edge[d], edge[d + 1])
                    met[mine] = among(np.sort(shared[begin[d] : begin[d + 1]].view(np.uint64)), anchors[mine])
                for d in np.flatnonzero(np.diff(copy_at) > 0):
                    if (copies[copy_at[d] : copy_at[d + 1]] == key[d]).any():  # goes as a whole
                        met[edge[d] : edge[d + 1]] = dealt[edge[d] : edge[d + 1]] = False
                met &= own & ~dealt
                # each place once; neighbouring windows have the same one
                once = np.flatnonzero(met)
                once = once[np.concatenate([[True], places[once[1:]] != places[once[:-1]]])] if len(once) else once
                low = np.maximum(places[once] - reach, w.first[doc[once]])
                high = np.minimum(places[once] + p.length, w.first[doc[once] + 1])
                many = np.flatnonzero(dealt)
                low, high = np.concatenate([low, at[many]]), np.concatenate([high, at[many] + p.length])
                group = np.concatenate([anchors[once], textgrams.mix(hashes[many])])
                rows = np.concatenate([once, many])
                if len(rows):
                    around = _slices(w.raw, w.start[low], w.end[high - 1])
                    of = doc[rows]
                    columns = [group.view(np.int64), ids[of], key[of], (low - w.first[of]).astype(np.int32), (places[rows] - low).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), around], ["group", "doc", "key", "start", "anchor", "around"])

    return run


_OCCURRENCE = "group long, doc long, key long, start int, anchor int, around string"


def _slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    at = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(int(at[-1]), dtype=np.int64) + np.repeat(starts - at[:-1], sizes)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(raw[place])]).cast(pa.string())


def _extended(length: int, seed: int, held: int) -> Callable:
    """Occurrences sorted by group and document: spans of words that an earlier document holds too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            kept.append(batch)
            rows += len(batch)
            if rows < held:
                continue
            table = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            group = table.column(0).to_numpy()
            other = np.flatnonzero(group != group[-1])
            end = int(other[-1]) + 1 if len(other) else 0
            if end:
                yield from _matches(table.slice(0, end), length, seed)[0]
            rest = table.slice(end)
            if not end:  # one group fills all that is held: of its rows only those that later ones can refer to stay
                found, first = _matches(rest, length, seed)
                yield from found
                rest = rest.take(pa.array(first))
            kept, rows = [rest], len(rest) if end else 0
        if kept:
            yield from _matches(pa.Table.from_batches(kept).combine_chunks().to_batches()[0], length, seed)[0] if sum(map(len, kept)) else []

    return run


def _matches(part: pa.RecordBatch, length: int, seed: int) -> tuple[list[pa.RecordBatch], np.ndarray]:
    """Spans of the later occurrences, and the rows that are the first of one of their windows."""
    group, doc, key, start, anchor = (part.column(i).to_numpy() for i in range(5))
    w = textgrams.words(part.column(5), lower=False)
    v = textgrams.second(w)
    n = np.diff(w.first)
    at = np.flatnonzero(textgrams.has_gram(w.first, length))
    row = np.repeat(np.arange(len(n)), n)[at]
    one, two = textgrams.gram_hashes(w, length)[at], textgrams.gram_hashes(v, length)[at]
    place = at - w.first[row] - anchor[row]  # windows are compared where they lie alike around the anchor
    order = np.lexsort((two, one, place, group[row]))  # stable: of equal windows the earliest document is first
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (group[row[a]] != group[row[b]]) | (place[a] != place[b]) | (one[a] != one[b]) | (two[a] != two[b])
    leader = row[order[np.flatnonzero(new)]]
    own, other = row[order], leader[np.cumsum(new) - 1]
    later = doc[other] < doc[own]
    pairs = np.unique(own[later] * len(n) + other[later])
    own, other = pairs // max(len(n), 1), pairs % max(len(n), 1)
    x, y = w.first[own] + anchor[own], w.first[other] + anchor[other]

    def agree(step: int, room: np.ndarray, alive: np.ndarray) -> np.ndarray:
        i, j = np.where(room, x + step, 0), np.where(room, y + step, 0)
        return alive & room & (w.hash[i] == w.hash[j]) & (v.hash[i] == v.hash[j])

    left, right = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    alive = np.ones(len(own), bool)
    for step in range(1, length - seed + 1):
        alive = agree(-step, (anchor[own] >= step) & (anchor[other] >= step), alive)
        left += alive
    alive = np.ones(len(own), bool)
    for step in range(length):
        alive = agree(step, (anchor[own] + step < n[own]) & (anchor[other] + step < n[other]), alive)
        right += alive
    long = left + right >= length
    own, begin = own[long], (start[own] + anchor[own] - left)[long]
    end = begin + (left + right)[long]
    out = pa.RecordBatch.from_pydict({"doc": doc[own], "key": key[own], "start": begin.astype(np.int32), "end": end.astype(np.int32)})
    return [out] if len(out) else [], np.unique(leader)


def _removing(plan, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            for part in textgrams.slabs(batch, "text", SLAB):
                w, at, hashes, *_ = _split(part.column(1), p.length, p.seed)
                ids, known = _ids(part.column(0))
                doc = _doc_of(w, at)
                gone = np.zeros(len(w.start) + 1, np.int64)
                own = np.flatnonzero(among(p.windows, hashes) & known[doc])
                own = own[p.first[np.searchsorted(p.windows, hashes[own])] < ids[doc[own]]]
                starts, ends = [at[own]], [at[own] + p.length]
                key, marks = part.column(2).to_numpy(), part.column(3)
                begin = _offsets(marks)
                mark_key, mark_start, mark_end = (marks.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
                for d in np.flatnonzero(np.diff(begin) > 0):
                    mine = slice(begin[d], begin[d + 1])
                    chosen = mark_key[mine] == key[d]
                    n = w.first[d + 1] - w.first[d]
                    end = np.minimum(mark_end[mine][chosen], n)
                    fit = end - mark_start[mine][chosen] >= p.length
                    starts.append(mark_start[mine][chosen][fit] + w.first[d])
                    ends.append(end[fit] + w.first[d])
                np.add.at(gone, np.concatenate(starts), 1)
                np.add.at(gone, np.concatenate(ends), -1)
                yield _kept(part, names, w, np.cumsum(gone[:-1]) > 0)

    return run


def _kept(part: pa.RecordBatch, names: list[str], w: textgrams.Words, cut: np.ndarray) -> pa.RecordBatch:
    """The text's own bytes, but for words that are cut and white space other than one space between words."""
    n = len(part)
    doc = np.repeat(np.arange(n), np.diff(w.first))
    keep = np.flatnonzero(~cut)
    last = np.zeros(len(keep), bool)
    if len(keep):
        last[:-1] = doc[keep[1:]] != doc[keep[:-1]]
        last[-1] = True
    step = np.zeros(len(w.raw) + 1, np.int8)
    np.add.at(step, w.start[keep], 1)
    np.add.at(step, w.end[keep], -1)
    inside = np.cumsum(step[:-1]) > 0
    raw = w.raw.copy()
    space = w.end[keep[~last]]
    raw[space], inside[space] = 0x20, True
    _, offsets = textgrams.utf8(part.column(1))
    sums = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(inside, out=sums[1:])
    text = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(sums[offsets]), pa.py_buffer(raw[inside])]).cast(pa.string())
    # maximal runs of cut words within a document
    begins = np.flatnonzero(cut & np.concatenate([[True], ~cut[:-1] | (doc[1:] != doc[:-1])])) if len(cut) else np.empty(0, int)
    ends = np.flatnonzero(cut & np.concatenate([~cut[1:] | (doc[1:] != doc[:-1]), [True]])) + 1 if len(cut) else np.empty(0, int)
    of = doc[begins]
    spans = pa.StructArray.from_arrays([pa.array(begins - w.first[of], pa.int64()), pa.array(ends - w.first[of], pa.int64())], ["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), spans)
    removed = np.bincount(doc[cut], minlength=n) if n else np.empty(0, int)
    results = [pa.array(np.diff(w.first), pa.int64()), pa.array(removed, pa.int64()), lists, text]
    return pa.RecordBatch.from_arrays([*(part.column(x) for x in names), *results], [*names, *_RESULTS])


_RESULTS = ("n_words", "n_removed", "repeats", "kept_text")
_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
_MARKS = "array<struct<key:bigint,start:int,end:int>>"


def remove_repeats(docs: DataFrame, identifier: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED, columns: list[str] | None = None, held: int = HELD, **listing) -> DataFrame:
    """``docs`` (or those of its columns that are named) with n_words, n_removed, repeats (maximal word spans [start, end) that go) and kept_text (the other words, one space between).

    A word goes if a window of ``length`` words over it also starts in a document with a smaller id; windows
    are judged on the input. Words are what ASCII white space separates, unchanged. Null texts count as
    empty. Documents without an id are neither earlier nor later than any: they stay whole and remove
    nothing. Rows that share an id (repeated rows) are not earlier than each other. Columns named as the
    results are replaced, others pass through, whatever their names. No documents: no rows. ``listing`` goes to ``hot_grams``.
    """
    spark = textgrams.small_batches(docs.sparkSession)
    docs = docs.drop(*_RESULTS)
    returned = [c for c in docs.columns if columns is None or c in columns]
    same = dict(docs.dtypes)[identifier] == "bigint"
    beside = [c for c in returned if c != text and (c != identifier or not same)]  # of the row, what is not passed as id and text
    row = [F.struct(*beside).alias("row")] if beside else []
    whole = docs.select(F.col(identifier).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *row)
    plain = whole.select("id", "text")
    filled = F.coalesce("text", F.lit(""))
    key = F.xxhash64(filled)

    def grams(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        for part in textgrams.slabs(batch, "text"):
            _, _, hashes, anchors, places = _split(part.column(1), length, seed)
            new = np.ones(len(places), bool)
            new[1:] = places[1:] != places[:-1]
            yield {"window": hashes, "anchor": anchors[new]}

    hot = hot_grams(plain, grams, ["window", "anchor"], **listing)
    first = np.full(len(hot["window"]), np.iinfo(np.int64).max)
    share = lambda: spark.sparkContext.broadcast(_Plan(length, seed, hot["window"], first, hot["anchor"]))
    plan = share()
    if len(first):
        found = plain.mapInArrow(_first_docs(plan), "k long, first long").groupBy("k").agg(F.min("first").alias("first")).toArrow()
        first[found.column(0).to_numpy()] = found.column(1).to_numpy()
        plan = share()

    copies = plain.where("id is not null").select("id", key.alias("key"), F.md5(filled).alias("digest"))
    earliest = copies.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    copies = copies.join(earliest, "digest").where("first < id").select("id", "key")

    met = Window.partitionBy("anchor")
    seeds = plain.mapInArrow(_seeds(plan), "anchor long, doc long")
    shared = seeds.withColumn("a", F.min("doc").over(met)).withColumn("b", F.max("doc").over(met)).where("a < b")
    none = F.lit(None).cast("long")
    both = shared.select(F.col("doc").alias("id"), "anchor", none.alias("key")).union(copies.select("id", none.alias("anchor"), "key"))
    lists = both.groupBy("id").agg(F.collect_list("anchor").alias("anchors"), F.collect_set("key").alias("copies"))
    around = plain.join(lists, "id", "left").select("id", "text", key.alias("key"), "anchors", "copies").mapInArrow(_occurrences(plan), _OCCURRENCE)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = around.repartition(width, "group").sortWithinPartitions("group", "doc")
    spans = dealt.mapInArrow(_extended(length, seed, held), "doc long, key long, start int, end int")
    spans = spans.union(copies.select("id", "key", F.lit(0).alias("start"), F.lit(_ALL).alias("end")))
    marks = spans.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("key", "start", "end")).cast(_MARKS).alias("marks"))

    out = whole.join(marks, "id", "left").select("id", "text", key.alias("key"), "marks", *(["row"] if row else []))
    names = ["id", *(["row"] if row else []), *(["text"] if text in returned else [])]
    schema = [*(whole.schema[x] for x in names), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("repeats", _SPANS), StructField("kept_text", StringType())]
    done = out.mapInArrow(_removing(plan, names), StructType(schema))
    back = [F.col("text").alias(c) if c == text else F.col("id").alias(c) if c == identifier and same else F.col("row")[c].alias(c) for c in returned]
    return done.select(*back, *_RESULTS)


def op10_substrings(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeats(docs, columns=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
with d as (select row_number() over () as k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (select k, doc_id, s, array_to_string(ws[s:s + 12], ' ') as g from (select k, doc_id, ws, unnest(generate_series(1, len(ws) - 12)) as s from d where len(ws) >= 13)),
f as (select k, s from (select k, s, doc_id, min(doc_id) over (partition by g) as first from w) where first < doc_id),
c as (select distinct k, unnest(generate_series(s, s + 12)) as p from f),
u as (select k, p, ws[p] as word from (select k, ws, unnest(generate_series(1, len(ws))) as p from d where len(ws) > 0)),
o as (select k, string_agg(word, ' ' order by p) as kept from u anti join c using (k, p) group by k),
r as (select k, count(*) as n from c group by k)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join r using (k) left join o using (k)
"""
