"""Token ids in sorted-string-table shards.

A shard holds documents in ascending order of their identifier::

    block* index bloom footer

A block is a zstd-compressed run of entries ``shared, unshared, length (varints), key suffix, value``: a
key is written as what differs from the key before it; a block's first key is whole. The index has each
block's first key, place and size; the Bloom filter has ten bits and seven probes a key; the footer is
fixed in size and says where index and filter are. A lookup reads footer, filter and index, then bisects
to the block. A value is the document's ids as little-endian unsigned integers of 16 bits, or of 32
where the vocabulary needs them.

Documents are dealt to shards by ranges of their identifier and sorted by Spark; each task writes one
shard under a name of its own attempt, and only the manifest, which Spark's own commit keeps, says which
shards count: a lost or repeated task leaves at most an unnamed file.
"""

from __future__ import annotations

import bisect
import hashlib
import io
import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from pvscan.llm import textgrams
from pvscan.llm.hotgrams import among
from pvscan.scratch import scratch_path, written

BLOCK = 1 << 16
BITS, PROBES = 10, 7
MAGIC = b"PVSST001"
_FOOTER = struct.Struct("<QQQQQQQ8s")


def key_of(identifier: int | str | None) -> bytes:
    """Bytes that sort as the identifiers do: none, then integers, then strings."""
    if identifier is None:
        return b"\0"
    if isinstance(identifier, str):
        return b"\2" + identifier.encode()
    return b"\1" + (int(identifier) + (1 << 63)).to_bytes(8, "big")


def identifier_of(key: bytes) -> int | str | None:
    return None if key[:1] == b"\0" else key[1:].decode() if key[:1] == b"\2" else int.from_bytes(key[1:], "big") - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * (b | 1)) % bits for i in range(PROBES)]


class Writer:
    """Entries must come in ascending order of key; equal keys may repeat."""

    def __init__(self, out, width: int) -> None:
        self.out, self.width, self.at, self.n, self.tokens = out, width, 0, 0, 0
        self.block, self.first, self.last, self.index, self.keys = io.BytesIO(), None, b"", [], []
        self.packer = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.n and key < self.keys[-1]:
            raise ValueError("keys must not descend")
        shared = 0
        if self.first is None:
            self.first = key
        else:
            shared = len(os.path.commonprefix([self.last, key]))
        value = ids.tobytes()
        self.block.write(_varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:])
        self.block.write(value)
        self.last = key
        self.keys.append(key)
        self.n += 1
        self.tokens += len(ids)
        if self.block.tell() >= BLOCK:
            self._flush()

    def _put(self, data: bytes) -> tuple[int, int]:
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return at, len(data)

    def _flush(self) -> None:
        if self.first is not None:
            self.index.append((self.first, *self._put(self.packer.compress(self.block.getvalue()))))
            self.block, self.first, self.last = io.BytesIO(), None, b""

    def close(self) -> None:
        self._flush()
        index = self._put(b"".join(_varint(len(k)) + k + _varint(at) + _varint(size) for k, at, size in self.index))
        bits = max(64, BITS * self.n)
        bloom = np.zeros((bits + 7) // 8, np.uint8)
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        where = self._put(bloom.tobytes())
        self._put(_FOOTER.pack(*index, *where, self.n, self.tokens, self.width, MAGIC))


class Reader:
    """``file`` is seekable and binary; blocks are read when asked for."""

    def __init__(self, file) -> None:
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        if size < _FOOTER.size:
            raise ValueError("not a shard: too short")
        ia, il, ba, bl, self.n, self.tokens, self.width, magic = _FOOTER.unpack(self._read(size - _FOOTER.size, _FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard: wrong magic")
        self.bloom, self.bits = self._read(ba, bl), max(64, BITS * self.n)
        self.first, self.place = [], []
        raw, at = self._read(ia, il), 0
        while at < len(raw):
            n, at = _read_varint(raw, at)
            self.first.append(raw[at : at + n])
            where, at = _read_varint(raw, at + n)
            size, at = _read_varint(raw, at)
            self.place.append((where, size))
        self.unpacker = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return bytes(self.file.read(n))

    def block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        data, at, key = self.unpacker.decompress(self._read(*self.place[k])), 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            unshared, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + unshared]
            at += unshared
            yield key, np.frombuffer(data, f"<u{self.width}", size // self.width, at)
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for k in range(len(self.place)):
            yield from self.block(k)

    def get(self, identifier: int | str | None) -> list[np.ndarray]:
        """All values of an identifier, in the order written; none if it is absent."""
        key = key_of(identifier)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits)):
            return []
        found = []
        for k in range(max(0, bisect.bisect_left(self.first, key) - 1), bisect.bisect_right(self.first, key)):
            found += [v for x, v in self.block(k) if x == key]
        return found


class Encoder:
    """Encodes columns of texts with a tokenizer file, exactly as its ``encode_batch`` does.

    A byte-level BPE without normaliser never joins the characters on both sides of a single space or
    line feed between two other characters, nor a letter and a mark of punctuation after it: texts are cut
    there, distinct pieces are encoded once and kept (up to ``most`` of them). A piece is found by its hash and
    then compared byte by byte; long pieces, and such whose bytes differ from the kept ones, are encoded where
    they stand. Texts that hold an added token's string, and all texts for other kinds of tokenizer, are encoded whole.
    """

    def __init__(self, path: str, end: int, most: int = 3_000_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        pre = about.get("pre_tokenizer") or {}
        self.cuts = about["model"]["type"] == "BPE" and not about.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not about.get("truncation") and not about.get("padding")
        self.added = [x["content"].encode() for x in about.get("added_tokens", [])]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4
        self.kind, self.end, self.most = np.dtype(f"<u{self.width}"), end, most
        self._forget()

    def _forget(self) -> None:
        """Known pieces: their hashes, sorted, where in ``pool`` their ids are and in ``text`` their bytes; some 35 bytes each."""
        self.known = np.empty(0, np.uint64)
        self.at, self.size, self.begin, self.length = (np.empty(0, t) for t in (np.int32, np.int32, np.int32, np.uint8))
        self.pool, self.filled = np.empty(1 << 16, self.kind), 0
        self.text, self.used = np.empty(1 << 18, np.uint8), 0

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        lists = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int32, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), self.kind, int(sizes.sum())), sizes

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        ids, sizes = self._encode([x.decode() for x in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.uint8, len(texts))
        self.pool = _grown(self.pool, self.filled, ids)
        self.text = _grown(self.text, self.used, raw)
        at = self.filled + np.cumsum(sizes, dtype=np.int64) - sizes
        begin = self.used + np.cumsum(lengths, dtype=np.int64) - lengths
        self.filled += len(ids)
        self.used += len(raw)
        order = np.argsort(np.concatenate([self.known, hashes]), kind="stable")
        self.known = np.concatenate([self.known, hashes])[order]
        for name, new in (("at", at), ("size", sizes), ("begin", begin), ("length", lengths)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, new.astype(old.dtype)])[order])

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text and the end id."""
        raw, offsets = textgrams.utf8(column)
        tail = np.array([self.end], self.kind)
        data = raw.tobytes()
        whole = np.zeros(len(offsets) - 1, bool)
        for token in self.added:
            at = data.find(token) if self.cuts else -1
            while at >= 0:
                whole[np.searchsorted(offsets, at, "right") - 1] = True
                at = data.find(token, at + 1)
        if not self.cuts:
            whole[:] = True
        starts = self._starts(raw, offsets)
        ends = np.append(starts[1:], len(raw)) if len(starts) else starts
        ids, each = self._pieces(raw, data, starts, ends) if self.cuts else (tail[:0], np.zeros(len(starts), np.int64))
        edge = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, offsets)]
        for d in range(len(offsets) - 1):
            if whole[d]:
                own = self._encode([data[offsets[d] : offsets[d + 1]].decode()])[0]
            else:
                own = ids[edge[d] : edge[d + 1]]
            yield np.concatenate([own, tail])

    def _pieces(self, raw: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and how many each has."""
        sizes = (ends - starts).astype(np.int64)
        short = np.flatnonzero(sizes <= textgrams.LONG)
        hashes = textgrams.span_hashes(raw, starts[short], ends[short])
        codes, distinct = pd.factorize(hashes)
        where = np.empty(len(distinct), np.int64)
        where[codes[::-1]] = short[::-1]
        if len(self.known) > self.most:
            self._forget()
        new = np.flatnonzero(~among(self.known, distinct))
        if len(new):
            at = where[new]
            self._learn(distinct[new], [data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slot = np.searchsorted(self.known, distinct)[codes]
        same = self.length[slot] == sizes[short]
        same &= textgrams.same_spans(raw, starts[short], self.text, self.begin[slot].astype(np.int64), np.where(same, sizes[short], 0))
        at, each = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        at[short[same]], each[short[same]] = self.at[slot[same]], self.size[slot[same]]
        pool = self.pool
        alone = np.ones(len(starts), bool)
        alone[short[same]] = False
        alone = np.flatnonzero(alone)
        if len(alone):
            own, n = self._encode([data[s:e].decode() for s, e in zip(starts[alone].tolist(), ends[alone].tolist(), strict=True)])
            at[alone], each[alone] = self.filled + np.cumsum(n) - n, n
            pool = np.concatenate([pool[: self.filled], own])
        begin = np.cumsum(each) - each
        return pool[np.repeat(at - begin, each) + np.arange(int(each.sum()))], each

    @staticmethod
    def _starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin: at each text, and around single spaces and line feeds between characters that are surely not white space."""
        n = len(raw)
        flag = np.zeros(n + 1, bool)
        flag[offsets[:-1]] = True
        if n > 2:
            here = raw[1:-1]
            left = _GRAPHIC[raw[:-2]]
            left[1:] |= (raw[1:-2] >= 0x80) & _LEAD_OF_TWO[raw[:-3]]
            right = _GRAPHIC[raw[2:]] | _LEAD[raw[2:]]
            inner = left & right & ~flag[1 : n - 1] & ~flag[2:n]
            feed = inner & (here == 0x0A)
            flag[1 : n - 1] |= (inner & (here == 0x20)) | feed
            flag[2:n] |= feed
            letter = _LETTER[raw[:-1]]
            letter[1:] |= (raw[:-2] == 0xC3) & (raw[1:-1] != 0x97) & (raw[1:-1] != 0xB7)
            flag[1:n] |= letter & _MARK[raw[1:]]
        return np.flatnonzero(flag[:n])


def _grown(pool: np.ndarray, filled: int, more: np.ndarray) -> np.ndarray:
    """``pool`` with ``more`` after its first ``filled`` values, doubled as needed."""
    while filled + len(more) > len(pool):
        pool = np.concatenate([pool, np.empty_like(pool)])
    pool[filled : filled + len(more)] = more
    return pool


_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True
_LEAD_OF_TWO = np.zeros(256, bool)
_LEAD_OF_TWO[0xC3:0xE0] = True
#: First bytes of characters among which there is no white space.
_LEAD = np.zeros(256, bool)
_LEAD[[*range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True

MANIFEST = "shard long, path string, n_docs long, n_tokens long"


#: A Python worker keeps its encoder, with the pieces it knows, for its next tasks.
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(tokenizer: str, end: int) -> Encoder:
    if (tokenizer, end) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer, end] = Encoder(tokenizer, end)
    return _ENCODERS[tokenizer, end]


def _writing(folder: str, tokenizer: str, end: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = writer = file = None
        for batch in batches:
            for part in textgrams.slabs(batch, "__text", 4 << 20):
                if writer is None:
                    encoder = _encoder(tokenizer, end)
                    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
                    fs.create_dir(base)
                    name = f"{shard:06d}-{uuid.uuid4().hex}.sst"
                    file = fs.open_output_stream(f"{base}/{name}")
                    writer = Writer(file, encoder.width)
                for i, ids in zip(part.column(0).to_pylist(), encoder(part.column(1)), strict=True):
                    writer.add(key_of(i), ids)
        if writer is not None:
            writer.close()
            file.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/{name}"], "n_docs": [writer.n], "n_tokens": [writer.tokens]})

    return write


def write_shards(docs: DataFrame, folder: str, tokenizer: str, identifier: str = "doc_id", text: str = "text", end: int = 0, shards: int | None = None) -> DataFrame:
    """Encodes and writes all documents; returns the manifest (shard, path, n_docs, n_tokens), shards in order of their keys.

    Null texts count as empty: their ids are the end id alone. Null identifiers come first. Documents
    that share an identifier (repeated rows too) are all kept, in order of text, in one shard. Other columns are not read, whatever
    their names. No documents: no shards. ``folder`` is a URI that all executors reach.
    """
    spark = textgrams.small_batches(docs.sparkSession)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(identifier).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    dealt = own.repartitionByRange(n, F.col("__id").asc_nulls_first()).sortWithinPartitions(F.col("__id").asc_nulls_first(), "__text")
    return written(dealt.mapInArrow(_writing(folder, tokenizer, end), MANIFEST), "manifest")


def _reading(kind: pa.DataType) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, place = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(place) as file:
                    rows: list[tuple] = []
                    for key, ids in Reader(file):
                        rows.append((identifier_of(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows, kind)
                            rows = []
                    if rows:
                        yield _rows(rows, kind)

    return read


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    a, b, c, d = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame, text_ids: bool = False) -> DataFrame:
    """Reads the shards back: id, start (ids of all documents before), n_tokens, ids_crc32.

    The running total goes over one row for each shard.
    """
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    own = manifest.select("path", F.coalesce(before, F.lit(0)).cast("long").alias("start"))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "string" if text_ids else "long"
    return own.repartition(n, "path").mapInArrow(_reading(pa.string() if text_ids else pa.int64()), f"id {kind}, start long, n_tokens long, ids_crc32 long")


def op9_sstable(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    manifest = write_shards(docs, scratch_path(spark, "sst"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(manifest).withColumnRenamed("id", "doc_id")
