"""Token ids in sorted-string-table shards.

A shard holds documents sorted by key: blocks of prefix-compressed entries, then a sparse index with
the first key and place of each block, a Bloom filter over the keys, and a footer that says where
those are. A lookup reads the footer, asks the filter, finds the block by binary search and scans it.

Layout, integers little-endian, varints in base 128:
  block    zstd of: entries (varint shared, varint unshared, varint value bytes, key suffix, value)
  index    zstd of: per block varint key bytes, key, u64 place, u32 bytes
  filter   bit array
  footer   u64 index place, u32 index bytes, u64 filter place, u32 filter bytes, u32 entries, u8 hashes,
           u8 bytes of an id, 8 bytes magic
Keys are ids as 8 bytes in order of value; the key of a row without an id is empty and comes first.
"""

from __future__ import annotations

import bisect
import hashlib
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import id_and_text, qualified, remembering, scratch, stored
from tidemark.llm._files import opened, put
from tidemark.llm.tokens import encoder, text_chunks

MAGIC = b"TIDESST1"
FOOTER = struct.Struct("<QIQIIBB8s")
BLOCK_BYTES = 64 << 10
FILTER_BITS_PER_KEY = 10
FILTER_HASHES = 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) % (1 << 64))


def id_of(key: bytes) -> int | None:
    return None if not key else struct.unpack(">Q", key)[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        at += 1
        n |= (byte & 127) << shift
        if byte < 128:
            return n, at
        shift += 7


def _filter_bits(key: bytes, size: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * b) % size for i in range(FILTER_HASHES)]


def shard_parts(entries: Iterator[tuple[bytes, bytes]], id_bytes: int) -> Iterator[bytes]:
    """The bytes of a shard, part by part, from entries sorted by key."""
    pack, keys, index, place = zstandard.ZstdCompressor(level=1).compress, [], bytearray(), 0
    block, first, last = bytearray(), b"", b""

    def closed() -> bytes:
        data = pack(bytes(block))
        index.extend(_varint(len(first)) + first + struct.pack("<QI", place, len(data)))
        return data

    for key, value in entries:
        if len(block) >= BLOCK_BYTES:
            data = closed()
            place += len(data)
            yield data
            block = bytearray()
        if not block:
            first, last = key, b""
        shared = len(os.path.commonprefix((last, key)))
        block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        last = key
        keys.append(key)
    if block:
        data = closed()
        place += len(data)
        yield data
    packed = pack(bytes(index))
    bits = np.zeros(max(64, len(keys) * FILTER_BITS_PER_KEY), bool)
    for key in keys:
        bits[_filter_bits(key, len(bits))] = True
    table = np.packbits(bits, bitorder="little").tobytes()
    yield packed
    yield struct.pack("<I", len(bits)) + table
    yield FOOTER.pack(place, len(packed), place + len(packed), len(table) + 4, len(keys), FILTER_HASHES, id_bytes, MAGIC)


class Shard:
    """Reads one shard; nothing but footer, index and filter stays in memory."""

    def __init__(self, uri: str):
        self.file = opened(uri)
        size = self.file.size()
        index, index_bytes, table, table_bytes, self.entries, _, self.id_bytes, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        data, at, self.first, self.places = zstandard.decompress(self._read(index, index_bytes)), 0, [], []
        while at < len(data):
            n, at = _read_varint(data, at)
            self.first.append(data[at : at + n])
            self.places.append(struct.unpack_from("<QI", data, at + n))
            at += n + 12
        self.bits = self._read(table, table_bytes)

    def _read(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def block(self, i: int) -> Iterator[tuple[bytes, bytes]]:
        data, at, key = zstandard.decompress(self._read(*self.places[i]), max_output_size=1 << 31), 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            rest, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, data[at : at + size]
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.places)):
            yield from self.block(i)

    def may_hold(self, key: bytes) -> bool:
        size = struct.unpack_from("<I", self.bits)[0]
        return all(self.bits[4 + (b >> 3)] >> (b & 7) & 1 for b in _filter_bits(key, size))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The token ids of each document of that id."""
        key, out = key_of(doc_id), []
        if not self.may_hold(key):
            return out
        i = max(0, bisect.bisect_left(self.first, key) - 1)
        while i < len(self.places) and self.first[i] <= key:
            out += [self.ids(value) for k, value in self.block(i) if k == key]
            i += 1
        return out

    def ids(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, f"<u{self.id_bytes}").astype("<u4")


def _written(tokenizer: str, end: int, root: str):
    @remembering
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, id_bytes = encoder(tokenizer), 2 if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4
        seen = {"entries": 0, "tokens": 0, "first": None}

        def entries():
            for batch in batches:
                names = batch.column("id").to_pylist()
                for first, texts in text_chunks(batch.column("text")):
                    for i, data in enumerate(encode.encode(texts), first):
                        ids = np.append(np.frombuffer(data, "<u4"), np.uint32(end))
                        seen["first"] = names[i] if not seen["entries"] else seen["first"]
                        seen["entries"] += 1
                        seen["tokens"] += len(ids)
                        yield key_of(names[i]), ids.astype(f"<u{id_bytes}").tobytes()

        shard = TaskContext.get().partitionId()
        path = f"{root}/shard-{shard:06d}.sst"
        size = put(path, shard_parts(entries(), id_bytes))
        if seen["entries"]:
            row = [shard, path, seen["first"], seen["entries"], seen["tokens"], size]
            types = [pa.int64(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], names=["shard", "path", "first_id", "entries", "tokens", "bytes"]
            )

    return run


def write_token_store(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, path: str | None = None
) -> DataFrame:
    """Writes the shards and gives their manifest (shard, path, first_id, entries, tokens, bytes).

    Documents are range-partitioned by id, each range one shard; a document's value is its ids and
    then ``end_id``. ``path`` is a folder that driver and executors share.
    """
    root = qualified(docs.sparkSession, path) if path else scratch(docs.sparkSession, "token_store")
    texts = id_and_text(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), "text")
    ordered = texts.repartitionByRange("id").sortWithinPartitions("id", "text")
    return stored(
        ordered.mapInArrow(_written(tokenizer, end_id, root), "shard long, path string, first_id long, entries long, tokens long, bytes long"),
        "manifest",
    )


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
            shard = Shard(path)
            for i in range(len(shard.places)):
                rows = []
                for key, value in shard.block(i):
                    ids = shard.ids(value)
                    rows.append((id_of(key), start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )


def read_token_store(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards; start counts the ids before it."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    shards = max(1, manifest.count())
    return placed.repartition(shards).mapInArrow(_read_back, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, doc_id: int) -> list[np.ndarray]:
    """Token ids of the documents of that id, from the shards whose range may hold it."""
    before = manifest.where(F.col("first_id").isNull() | (F.col("first_id") <= doc_id)).orderBy(F.desc_nulls_last("first_id")).limit(2)
    return [ids for row in before.collect() for ids in Shard(row["path"]).get(doc_id)]


def token_store(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, written to shards and read back.

    Null and empty texts are documents of one id. Rows without an id come first; rows that share one
    are ordered by their texts. An empty table gives an empty result. Other columns are ignored.
    """
    return read_token_store(write_token_store(docs, tokenizer, id_col, text_col, end_id))
