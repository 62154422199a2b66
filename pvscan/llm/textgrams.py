"""Words and word n-gram hashes of many texts at once, with numpy on their UTF-8 bytes.

Texts stay in Arrow's buffers; words are runs of bytes of one class, so that splitting needs no
Python object per word. A gram's hash is a polynomial over its words' hashes, so that
word limits count ("ab c" and "a bc" differ). Where equality is final, two hashes of different seeds
are taken (128 bits) or the bytes are compared.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession

U = np.uint64
_LIBC = ctypes.CDLL(None)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher, elementwise."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


#: Spans of more bytes than this are hashed one at a time, by blake2b.
LONG = 64
#: Keeps the first k bytes of a little-endian lane of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(9, 14)]] = True
#: Byte classes: what is not ASCII white space; ASCII digits and lower-case letters, and all beyond ASCII.
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another, and where each begins (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one integer (zeros beyond the end)."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    return np.ndarray(len(raw) + 1, "<u8", padded.data, 0, (1,))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each byte span; another ``seed`` gives a hash that is independent of it.

    Eight bytes at a time go through a mixer that is not linear, so no two texts of a regular make collide
    by construction; long spans get a cryptographic hash.
    """
    size = (ends - starts).astype(np.int64)
    with np.errstate(over="ignore"):
        out = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + U(2 * seed + 1))
        lanes = _lanes(raw)
        short = size <= LONG
        at = np.flatnonzero(short & (size > 0))
        k = 0
        while len(at):
            left = size[at] - k
            lane = lanes[starts[at] + k] & _FIRST[np.minimum(left, 8)]
            out[at] = mix((out[at] ^ lane) * U(0xD1342543DE82EF95 + 2 * seed))
            at = at[left > 8]
            k += 8
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(~short).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def same_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether spans of ``a`` and ``b`` (of equal sizes) have the same bytes."""
    same = np.ones(len(sizes), bool)
    left_lanes, right_lanes = _lanes(a), _lanes(b)
    at, k = np.flatnonzero(sizes > 0), 0
    while len(at):
        left = sizes[at] - k
        same[at] &= (left_lanes[a_starts[at] + k] ^ right_lanes[b_starts[at] + k]) & _FIRST[np.minimum(left, 8)] == 0
        at = at[left > 8]
        k += 8
    return same


class Words(NamedTuple):
    """start, end: of each word in ``raw``; first: each document's first word, then the number of words."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words(column: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """Words of each text: maximal runs of bytes of the given class, with A-Z lower-cased first."""
    raw, offsets = utf8(column)
    if lower:
        raw = LOWER[raw]
    return _split(raw, offsets, kind)


def _split(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    inside = kind[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(raw, start, end, span_hashes(raw, start, end), np.searchsorted(start, offsets))


def second(w: Words) -> Words:
    """The same words with hashes of another seed."""
    return w._replace(hash=span_hashes(w.raw, w.start, w.end, 1))


def gram_hashes(w: Words, k: int) -> np.ndarray:
    """For each word the hash of the k words from it on; only right where a document has that many."""
    return rolled(w.hash, k)


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Of each place the hash of the ``k`` hashes from it on (fewer at the end)."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(h), U)
        for j in range(min(k, len(h))):
            out *= U(0xD1342543DE82EF95)
            out[: len(h) - j] += h[j:] if j else h
        return mix(out ^ U(k))


def has_gram(first: np.ndarray, k: int) -> np.ndarray:
    """For each word, whether k words of its document begin there."""
    n = np.diff(first)
    total = int(first[-1])
    left = np.repeat(first[1:], n) - np.arange(total)
    return left >= k


def give_back() -> None:
    """Returns freed memory to the system; a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def small_batches(spark: SparkSession) -> SparkSession:
    """Bounds the bytes of an Arrow batch for the session, unless it has a bound of its own: ten thousand rows of long texts are too much at once."""
    if spark.conf.get(_BYTES) == "67108864b":  # Spark's own
        spark.conf.set(_BYTES, "4m")
    return spark


_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def slabs(batch: pa.RecordBatch, text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of text at most, or of one row."""
    i = batch.schema.get_field_index(text)
    column = batch.column(i)
    if not len(column):
        return
    lengths = np.nan_to_num(pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    part = np.cumsum(lengths) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
    give_back()
