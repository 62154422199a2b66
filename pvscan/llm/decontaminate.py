"""Benchmark decontamination with a broadcast hash set of test n-grams, in built-in expressions only.

Benchmark texts are normalised into words and cut into windows of ``n`` words (a shorter item is one
window). They are a broadcast hash relation, keyed by the hash of their first words, so that windows of all
lengths are found in one pass. Each training text's token windows are looked up in it; a hit counts only if all
words agree. Hits are gathered by the digest of their text and come back to the documents by a join on it, broadcast
where they are few (they are counted); texts are not shuffled then.

The relation is used up to ``max_windows`` distinct windows (counted first). Of a larger benchmark a Bloom filter of
bounded size is sent out instead. Windows of training texts whose first words pass it, some fiftieth of them, are joined
with the benchmark's on their digests, in salted parts, with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pvscan.scratch import written

#: What lies between words. Splitting there is some twenty times as fast as matching the words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 13
#: Words of a window that its key in the hash table covers; windows of any length share one pass so.
HEAD = 4
#: Bits of the Bloom filter for each window and in all, and parts of a digest's windows.
BITS, MOST_BITS, SALTS = 16, 1 << 24, 16
#: Texts with hits are broadcast up to so many hits, items and keys in all.
FEW = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cases A-Z and takes the words; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN), "")


def _run_hashes(hashes: Column, length: int) -> Column:
    """Of each run of ``length`` words, in order; empty if there are fewer."""
    all_ = F.transform(hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, length)]))
    return F.when(F.size(hashes) >= length, F.slice(all_, F.lit(1), F.size(hashes) - F.lit(length - 1))).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, n: int) -> DataFrame:
    """Distinct windows of the items: length, hash, words (space-joined), items (sorted strings)."""
    at = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("ws")).where(F.size("ws") > 0)
    at = at.withColumn("length", F.least(F.size("ws"), F.lit(n)))
    each = F.transform(F.sequence(F.lit(1), F.size("ws") - F.col("length") + 1), lambda i: F.slice("ws", i, F.col("length")))
    at = at.select("item", "length", F.explode(each).alias("ws"))
    return at.groupBy("length", F.array_join("ws", " ").alias("words")).agg(F.array_sort(F.collect_set(F.coalesce("item", F.lit("")))).alias("items"))


def _hash_of(grams: DataFrame) -> DataFrame:
    """Adds the key of a window in the table: the hash of its first words, HEAD of them at most."""
    grams = grams.withColumn("hs", F.transform(F.split("words", " "), lambda x: F.xxhash64(x))).withColumn("head", F.least("length", F.lit(HEAD)))
    own = F.lit(None).cast("bigint")
    for head in range(1, HEAD + 1):
        own = F.when(F.col("head") == head, F.xxhash64(*[F.get("hs", F.lit(j)) for j in range(head)])).otherwise(own)
    return grams.withColumn("hash", own).drop("hs")


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = N, max_windows: int = 100_000, few: int = FEW) -> DataFrame:
    """``docs`` with n_words, hits (array of start, length, items; starts count words from 0), n_hit and items.

    n_hit counts words inside any occurrence of a benchmark window; items holds the ids (sorted strings)
    of the items whose windows occur. Null and empty texts, and such without words, have none of either;
    so has every text if the benchmark is empty. Items with a null id count as the empty id. Repeated rows
    are scanned alike. Other columns pass through, whatever their names, but those named as the results are replaced. No documents: no rows.
    """
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in _RESULTS]).alias("row"))
    text_ = F.col("row")[text]
    found = _near(_found(rows.select(text_.alias("text")), benchmark, item, item_text, n, max_windows), few)
    out = rows.withColumn("key", _key(text_)).join(found.drop("n_words"), "key", "left")
    filled = [F.coalesce("hits", F.array().cast(_HIT)).alias("hits"), F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")]
    return out.select("row.*", F.size(words(text_)).cast("bigint").alias("n_words"), *filled)


_RESULTS = ("n_words", "hits", "n_hit", "items")
_HIT = "array<struct<start:int,length:int,items:array<string>>>"


def _key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _near(found: DataFrame, few: int) -> DataFrame:
    """Broadcast, if what it holds is little."""
    size = found.agg(F.sum(F.size("hits") + F.size("items") + 8)).first()[0] or 0
    return F.broadcast(found) if size <= few else found


def _found(texts: DataFrame, benchmark: DataFrame, item: str, item_text: str, n: int, max_windows: int) -> DataFrame:
    """key, n_words, hits, n_hit and items of each distinct text with a hit, as a table."""
    grams = written(_hash_of(benchmark_windows(benchmark, item, item_text, n)), "windows")
    kinds = sorted(tuple(r) for r in grams.groupBy("head", "length").agg(F.count("*").alias("n")).collect())  # a row for each window length
    own = texts.select(_key(F.col("text")).alias("key"), words(F.col("text")).alias("ws")).withColumn("h", F.transform("ws", lambda x: F.xxhash64(x)))
    met = (_by_broadcast if sum(k[2] for k in kinds) <= max_windows else _by_shuffle)(own, grams, kinds)
    hits = met.groupBy("key").agg(F.first("n_words").alias("n_words"), F.array_sort(F.collect_set(F.struct("start", "length", "items"))).cast(_HIT).alias("hits"))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["items"]))))
    return written(hits.select("key", "n_words", "hits", F.size(covered).cast("bigint").alias("n_hit"), items.alias("items")), "hits")


def _once(windows: Column) -> Column:
    """Spark filters empty arrays before it explodes them; that filter must not be pushed below, where it would compute all hashes again for each window."""
    return F.when(F.monotonically_increasing_id() >= 0, windows)


def _by_broadcast(own: DataFrame, grams: DataFrame, kinds: list[tuple]) -> DataFrame:
    """Every window's key meets the broadcast set; a hit counts if all its words agree."""
    heads = sorted({k[0] for k in kinds})
    keys = F.concat(F.array().cast("array<bigint>"), *[_run_hashes(F.col("h"), head) for head in heads])
    own = own.withColumn("keys", _once(keys)).select("key", "ws", F.posexplode("keys").alias("at", "hash"))
    # the keys of all head lengths stand one after another
    before, start = F.lit(0), F.lit(0)
    for head in heads:
        start = F.when(F.col("at") >= before, F.col("at") - before).otherwise(start)
        before = before + F.greatest(F.size("ws") - head + 1, F.lit(0))
    met = own.join(F.broadcast(grams.select("hash", "length", "words", "items")), "hash").withColumn("start", start.cast("int"))
    same = (F.col("length") <= F.size("ws") - F.col("start")) & (F.col("words") == F.array_join(F.slice("ws", F.col("start") + 1, F.col("length")), " "))
    return met.where(same).select("key", F.size("ws").cast("bigint").alias("n_words"), "start", "length", "items")


def _bloom(hashes: DataFrame, bits: int) -> bytes:
    """Two bits are set for each ``hash``; eight to a byte. Its size is bounded, whatever the number of hashes."""
    probes = hashes.select(F.explode(F.array("hash", F.xxhash64("hash"))).alias("x"))
    probes = probes.select(F.pmod("x", F.lit(bits // 8)).alias("id"), F.pmod(F.shiftright("x", 40), F.lit(8)).cast("int").alias("bit"))
    rows = probes.groupBy("id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("bit"))).alias("byte")).collect()
    out = bytearray(bits // 8)
    for r in rows:
        out[r["id"]] = r["byte"]
    return bytes(out)


def _passes(bloom: bytes, x: Column) -> Column:
    def one(y: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.lit(bloom), F.pmod(y, F.lit(len(bloom))).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, F.pmod(F.shiftright(y, 40), F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return one(x) & one(F.xxhash64(x))


def _by_shuffle(own: DataFrame, grams: DataFrame, kinds: list[tuple]) -> DataFrame:
    """Windows whose keys pass the Bloom filter are joined with the benchmark's on their words' SHA-256."""
    kind, found = "array<struct<start:int,length:int,digest:string>>", [F.array().cast("array<struct<start:int,length:int,digest:string>>")]
    for head in sorted({k[0] for k in kinds}):
        many = sum(k[2] for k in kinds if k[0] == head)
        bloom = _bloom(grams.where(F.col("head") == head).select("hash"), min(MOST_BITS, 1 << max(10, (BITS * many - 1).bit_length())))
        passing = F.transform(_run_hashes(F.col("h"), head), lambda x, i: F.when(_passes(bloom, x), i))  # noqa: B023
        own = own.withColumn(f"at{head}", F.filter(passing, lambda i: i.isNotNull()))
        for length in (k[1] for k in kinds if k[0] == head):
            fit = F.filter(f"at{head}", lambda i: i + length <= F.size("ws"))  # noqa: B023
            found.append(F.transform(fit, lambda i: F.struct(i.cast("int").alias("start"), F.lit(length).alias("length"), F.sha2(F.array_join(F.slice("ws", i + 1, length), " "), 256).alias("digest"))).cast(kind))  # noqa: B023
    windows = own.withColumn("found", _once(F.concat(*found))).select("key", F.size("ws").cast("bigint").alias("n_words"), F.explode("found").alias("w"))
    windows = windows.select("key", "n_words", "w.*", F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt"))
    items = grams.select("length", F.sha2("words", 256).alias("digest"), "items", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    return windows.join(items, ["length", "digest", "salt"]).select("key", "n_words", "start", "length", "items")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more lie in benchmark windows."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = N, max_windows: int = 100_000, few: int = FEW) -> DataFrame:
    """``docs`` without the contaminated ones; columns as before. See ``scan`` for edge cases."""
    found = _found(docs.select(F.col(text).alias("text")), benchmark, item, item_text, n, max_windows)
    bad = _near(found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select("key", "hits", "items"), few)
    rows = docs.select(F.struct("*").alias("row")).withColumn("key", _key(F.col("row")[text]))
    return rows.join(bad.select("key"), "key", "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "clean_text", **how) -> DataFrame:
    """Adds ``out``: the text's words outside of all hits, space-joined and lower-cased, or the text itself if none is hit."""
    hit = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))
    left = F.array_join(F.get(F.transform(F.array(hit), lambda own: F.filter(words(F.col(text)), lambda x, i: ~F.array_contains(own, i))), F.lit(0)), " ")
    return scan(docs, benchmark, text, **how).withColumn(out, F.when(F.col("n_hit") > 0, left).otherwise(F.col(text)))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    seen = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return seen.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


SQL = rf"""
with d as (select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
i as (select item, ws, least(len(ws), {N}) as n from b where len(ws) > 0),
g as (select distinct item, n, array_to_string(ws[s:s + n - 1], ' ') as gram from (select item, ws, n, unnest(generate_series(1, len(ws) - n + 1)) as s from i)),
l as (select distinct n from g),
w as (select k, n, s, array_to_string(ws[s:s + n - 1], ' ') as gram from (select k, ws, n, unnest(generate_series(1, len(ws) - n + 1)) as s from d, l where len(ws) >= n)),
h as (select k, s, n, item from w join g using (n, gram)),
c as (select k, count(distinct p) as n_hit from (select k, unnest(generate_series(s, s + n - 1)) as p from (select distinct k, s, n from h)) group by k),
t as (select k, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct k, item from h) group by k)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join c using (k) left join t using (k)
"""
