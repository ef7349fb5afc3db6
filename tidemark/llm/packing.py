"""Sum-of-squares online packing of token documents into windows.

A task packs the documents of its partition as they come. A document is cut into full windows and a
remainder. The remainder goes to the fill level that makes the sum of squared counts of partially
filled windows smallest, by an array with the count at each level; a new window is level 0. What is
still open at the end is poured together by cutting, and the last window is cut at powers of two,
at which sequences need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import id_and_text, remembering
from tidemark.llm.tokens import MEMORY_BYTES, encoder, text_chunks

WINDOW = 1024

#: A piece of a document: (document, its first id, ids as bytes, ids of the whole document).
Piece = tuple[object, int, bytes, int]


def _cut(piece: Piece, ids: int) -> tuple[Piece, Piece]:
    name, start, data, whole = piece
    return (name, start, data[: 4 * ids], whole), (name, start + ids, data[4 * ids :], whole)


class SquaresPacker:
    """Windows of ``size`` ids; add() and finish() give the sequences that are complete, as lists of pieces."""

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(size)]

    def add(self, name: object, data: bytes) -> Iterator[list[Piece]]:
        rest: Piece = (name, 0, data, len(data) // 4)
        while len(rest[2]) >= 4 * self.size:
            full, rest = _cut(rest, self.size)
            yield [full]
        n = len(rest[2]) // 4
        if n:
            level = self._level(n)
            pieces = self.open[level].pop() if level else []
            pieces.append(rest)
            self.count[level] -= level > 0
            if level + n == self.size:
                yield pieces
            else:
                self.open[level + n].append(pieces)
                self.count[level + n] += 1

    def _level(self, n: int) -> int:
        """The level to place n ids on; of equals the fullest."""
        last = self.size - n
        change = 2 * self.count[n : self.size + 1] + 1
        change[last] = 0
        change[1:] += 1 - 2 * self.count[1 : last + 1]
        change[1:][self.count[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def finish(self) -> Iterator[list[Piece]]:
        window: list[Piece] = []
        room = self.size
        for level in range(self.size - 1, 0, -1):
            for pieces in self.open[level]:
                for piece in pieces:
                    while len(piece[2]) // 4 > room:
                        head, piece = _cut(piece, room)
                        yield [*window, head]
                        window, room = [], self.size
                    window.append(piece)
                    room -= len(piece[2]) // 4
                    if not room:
                        yield window
                        window, room = [], self.size
        left = self.size - room
        while left:
            part = 1 << (left.bit_length() - 1)
            left -= part
            sequence: list[Piece] = []
            while part:
                piece = window.pop(0)
                if len(piece[2]) // 4 > part:
                    piece, later = _cut(piece, part)
                    window.insert(0, later)
                sequence.append(piece)
                part -= len(piece[2]) // 4
            yield sequence


def _pack(tokenizer: str, end: int, size: int, id_type: pa.DataType, memory_bytes: int):
    last = np.array([end], "<u4").tobytes()

    def rows(sequences: Iterator[list[Piece]], sequence_id: int, out: list) -> int:
        for pieces in sequences:
            offset = 0
            for name, start, data, whole in pieces:
                out.append((name, start, len(data) // 4, zlib.crc32(data), whole, sequence_id, offset))
                offset += len(data) // 4
            sequence_id += 1
        return sequence_id

    def batch_of(out: list) -> pa.RecordBatch:
        types = [id_type, *[pa.int64()] * 6]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    @remembering
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encode = SquaresPacker(size), encoder(tokenizer, memory_bytes).encode
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            names, out = batch.column("id").to_pylist(), []
            for first, texts in text_chunks(batch.column("text")):
                for i, data in enumerate(encode(texts), first):
                    number = rows(packer.add(names[i], data + last), number, out)
            yield batch_of(out)
        out = []
        rows(packer.finish(), number, out)
        yield batch_of(out)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    window: int = WINDOW,
    memory_bytes: int = MEMORY_BYTES,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    A document is its token ids and then ``end_id``; each id lies in exactly one piece, and pieces of a
    sequence follow each other without gaps. Sequences have ``window`` ids, but for at most a few a
    partition whose lengths are powers of two. ``tokenizer`` is a tokenizers file that executors have, ``memory_bytes``
    what a worker remembers of its words.

    Null and empty texts are documents of one id. Ids may be null or repeat: each row is a document
    of its own. An empty table gives an empty result. Other columns are ignored.
    """
    texts = id_and_text(docs, id_col, text_col)
    kind = texts.schema["id"].dataType
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    from pyspark.sql.pandas.types import to_arrow_type

    return texts.mapInArrow(_pack(tokenizer, end_id, window, to_arrow_type(kind), memory_bytes), schema)
