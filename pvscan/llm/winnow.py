"""Document fingerprints by winnowing, in built-in expressions only.

A text is its bytes in UTF-8. Hashes of all runs of ``k`` bytes are taken, one at each place; of every ``w``
neighbouring hashes the least is kept, the rightmost of equal ones, with the place where its run begins. Two
texts that share ``w + k - 1`` bytes in a row, anywhere, therefore share a fingerprint at known places, whether
or not there are spaces between words. A text of fewer bytes is one run; one of fewer runs is one window.

Least hashes of windows come from a few passes over the array of hashes, each of which doubles the windows. A long text is taken in segments, so that no more than a segment's hashes are held at once.
The fingerprint of a text that joins the beginnings of two others is made from theirs, without hashing all of it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

K, W = 16, 32
#: Windows of a text that are taken at once.
SEGMENT = 1 << 14


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _hashes(piece: Column, k: int) -> Column:
    """Of each run of ``k`` bytes, in order; of a shorter piece its own."""
    each = F.transform(F.sequence(F.lit(1), F.length(piece) - F.lit(k - 1)), lambda i: F.xxhash64(F.substring(piece, i, F.lit(k))))
    return F.when(F.length(piece) >= k, each).otherwise(F.array(F.xxhash64(piece)))


def _least(hashes: Column, w: int, then: Callable[[Column], Column], wide: int = 1) -> Column:
    """``then`` of the least values of all windows of ``w``, given those of windows of ``wide``; windows that reach beyond the end are cut there."""
    if wide == w:
        return then(hashes)
    step = min(wide, w - wide)
    ahead = F.filter(hashes, lambda x, i: i >= step)  # some times as fast as a slice
    wider = F.zip_with(hashes, ahead, lambda x, y: F.when(y < x, y).otherwise(x))
    return _let(wider, lambda a: _least(a, w, then, wide + step))


def _kept(hashes: Column, least: Column, w: int, skip: Column, base: Column) -> Column:
    """hash and position of each window's choice that the window before doesn't have; the first ``skip`` windows are not reported."""
    last = F.least(F.lit(w), F.size(hashes)) - 1
    new = F.transform(least, lambda x, i: F.when((i == 0) | (x != F.get(least, i - 1)) | (x == F.get(hashes, i + last)), i))

    def place(i: Column) -> Column:
        back = F.array_position(F.reverse(F.slice(hashes, i + 1, last + 1)), F.get(least, i)).cast("int")
        return F.when(F.get(least, i) == F.get(hashes, i + last), i + last).otherwise(i + last + 1 - back)

    chosen = F.filter(new, lambda i: (i >= skip) & (i < F.size(hashes) - last))  # whole windows only
    return F.transform(chosen, lambda i: F.struct(F.get(least, i).alias("hash"), (base + place(i)).alias("position")))


def _segment(piece: Column, k: int, w: int, skip: Column, base: Column) -> Column:
    def windows(h: Column) -> Column:
        many = _least(h, w, lambda m: _kept(h, m, w, skip, base))
        return F.when(F.size(h) >= w, many).otherwise(_let(F.array(F.array_min(h)), lambda m: _kept(h, m, w, skip, base)))

    return _let(_hashes(piece, k), windows)


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W, segment: int = SEGMENT) -> DataFrame:
    """Adds ``out``: array of (hash, position), in order of position; positions count bytes of UTF-8 from 0.

    Null and empty texts have an empty array. Each row is fingerprinted by itself: ties, repeated rows and other
    columns (but one named as ``out``, which is replaced) have no influence. No rows: no rows.
    """

    def whole(raw: Column) -> Column:
        windows = F.greatest(F.length(raw) - F.lit(k + w - 2), F.lit(1))

        def part(j: Column) -> Column:
            first = j * segment - F.when(j > 0, 1).otherwise(0)  # the window before comes along, to compare with
            size = F.least((j + 1) * segment, windows) - first + F.lit(k + w - 2)
            return _let(F.substring(raw, first + 1, size), lambda piece: _segment(piece, k, w, F.when(j > 0, 1).otherwise(0), first))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.floor((windows - 1) / segment).cast("int")), part))

    found = F.when(F.length(F.col(text)) > 0, _let(F.col(text).cast("binary"), whole)).otherwise(F.array().cast("array<struct<hash:bigint,position:int>>"))
    # A filter on the fingerprint is not to be pushed below it, where it would compute all of this again.
    return df.withColumn(out, F.when(F.monotonically_increasing_id() >= 0, found))


def with_joined_fingerprint(df: DataFrame, text: str, left: str, before: str, after: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """Adds ``out``: what ``with_fingerprint`` gives of ``text``, of which the first ``left`` bytes begin a text with fingerprint ``before`` and the others begin one with ``after``.

    A window's choice depends on its own bytes only, and choices never go back from a window to the next. So windows within
    a part choose as in its whole text; those over the seam, with one on either side, and the last one are hashed again,
    and tell how far the choices of ``before`` and ``after`` are those of windows within the parts. Parts may be shorter
    than a window, or empty. Null and empty texts have an empty array. Other columns stay as they are.
    """
    span, taken = w + k - 1, {c.lower() for c in df.columns}
    size, at = F.octet_length(F.col(text)), F.col(left).cast("int")
    begin, end = F.greatest(at - span, F.lit(0)), F.least(at + span, size)
    names = seam, final = [next(c for i in range(len(taken) + 1) if (c := f"{out}_{kind}{i}").lower() not in taken) for kind in ("seam", "final")]
    raw = F.col(text).cast("binary")
    df = df.withColumn(seam, F.substring(raw, begin + 1, end - begin)).withColumn(final, F.substring(raw, size - span + 1, F.lit(span)))
    for piece in names:
        df = with_fingerprint(df, piece, piece, k, w)

    def moved(fingerprint: Column, by: Column) -> Column:
        return F.transform(fingerprint, lambda x: F.struct(x["hash"].alias("hash"), (x["position"] + by).alias("position")))

    def joined(middle: Column) -> Column:
        none = F.array().cast("array<struct<hash:bigint,position:int>>")
        first, last = F.get(middle, F.lit(0))["position"], F.element_at(middle, -1)["position"]
        upto = F.get(F.col(final), F.lit(0))["position"] + size - span
        ahead = F.when(at >= span, _let(first, lambda p: F.filter(F.col(before), lambda x: x["position"] < p))).otherwise(none)
        rest = lambda p: F.filter(F.col(after), lambda x: (x["position"] > p["low"]) & (x["position"] <= p["high"]))
        behind = F.when(size - at >= span, moved(_let(F.struct((last - at).alias("low"), (upto - at).alias("high")), rest), at)).otherwise(none)
        return F.concat(ahead, middle, behind)

    whole = F.when(size > 0, _let(moved(F.col(seam), begin), joined)).otherwise(F.array().cast("array<struct<hash:bigint,position:int>>"))
    return df.withColumn(out, F.when(F.monotonically_increasing_id() >= 0, whole)).drop(*names)


def positions(fingerprint: Column) -> Column:
    """First byte of each kept run."""
    return F.transform(fingerprint, lambda x: x["position"])


def hash_set(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: x["hash"]))


def as_text(fingerprint: Column) -> Column:
    """``hash@position`` of each kept run, hash in hex."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.lower(F.hex(x["hash"])), F.lit("@"), x["position"].cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either > 0, both.cast("double") / either).otherwise(F.lit(1.0))


def successors(keys: DataFrame, key: str, base: int = 4096) -> DataFrame:
    """Each of the distinct integers ``key`` with the next larger one as ``next`` (the last: null).

    Keys are dealt into runs of ``base`` (a power of two) values, so that no task sorts more than ``base`` of them; the
    last of a run takes the first key of the next run that has any, found the same way.
    """
    lo, hi = keys.agg(F.min(key), F.max(key)).first()
    if lo is None or hi - lo < base:
        return keys.withColumn("next", F.lead(key).over(Window.orderBy(key)))
    run = f"{key}_run"
    runs = keys.withColumn(run, F.shiftright(key, base.bit_length() - 1))
    ahead = F.lead(key).over(Window.partitionBy(run).orderBy(key))
    firsts = runs.groupBy(run).agg(F.min(key).alias("first"))
    after = successors(firsts.select(run), run, base).join(firsts.select(F.col(run).alias("next"), F.col("first").alias("then")), "next", "left").select(run, "then")
    return runs.withColumn("in", ahead).join(after, run, "left").select(key, F.coalesce("in", "then").alias("next"))


#: Blocks of rows without an id, by their text's hash.
_LOOSE = 4096


def op5_winnowing(spark, sf_dir: str, block: int = 256) -> DataFrame:
    """Fingerprints of every text of documents, of its edited text, and their likeness.

    The next document is found inside blocks of ``block`` (a power of two) consecutive ids, one task sorting such a block;
    the first document of each block also goes to the block before. Rows that share a doc_id follow one
    another in order of text; those without one come first, in order of their text's hash, in blocks of their own. Null texts count as empty.
    A single document follows itself. No documents: no rows. Texts are shuffled once. An edited text begins two whole texts
    one after the other, so its fingerprint is joined from theirs, with what lies over the seam hashed again.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    low = docs.agg(F.min("doc_id")).first()[0] or 0
    loose = F.lit(low // block - _LOOSE) + F.pmod(F.shiftright(F.xxhash64("text"), 52), F.lit(_LOOSE))
    at = F.coalesce(F.shiftright("doc_id", block.bit_length() - 1), loose)
    docs = docs.withColumn("blk", at.cast("bigint"))
    blocks = successors(docs.select("blk").distinct(), "blk")
    first = docs.agg(F.min("blk")).first()[0]
    blocks = blocks.select("blk", F.coalesce("next", F.lit(first)).alias("next"))
    dealt = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "blk")
    order = Window.partitionBy("blk").orderBy(F.col("doc_id").asc_nulls_first(), F.when(F.col("doc_id").isNull(), F.xxhash64("text")), "text")
    heads = dealt.withColumn("k", F.row_number().over(order)).where("k = 1").select(F.col("blk").alias("next"), F.col("text").alias("head"))
    heads = blocks.join(heads, "next").select("blk", "head")
    heads = with_fingerprint(heads, "head", "head_fp").select("blk", "head", "head_fp")
    own = with_fingerprint(dealt, "text", "fp")
    own = own.withColumn("ahead", F.lead("text").over(order)).withColumn("ahead_fp", F.lead("fp").over(order))
    own = own.join(heads, "blk", "left")
    own = own.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    own = own.withColumn("following", F.coalesce("ahead", "head")).withColumn("next_fp", F.coalesce("ahead_fp", "head_fp"))
    own = own.withColumn("begin", F.col("text").substr(F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")))
    own = own.withColumn("edited", F.concat("begin", F.col("following").substr(F.lit(1), F.col("half")))).withColumn("left", F.octet_length("begin"))
    own = own.select("doc_id", "n_chars", "fp", "next_fp", "edited", "left")
    own = with_joined_fingerprint(own, "edited", "left", "fp", "next_fp", "edited_fp")
    for prints, hashes in (("fp", "own_set"), ("next_fp", "next_set"), ("edited_fp", "edited_set")):
        own = own.withColumn(hashes, hash_set(F.col(prints)))
    return own.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("own_set"), F.col("edited_set")).alias("near_edited"), likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
    )
