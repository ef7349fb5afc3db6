"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned against training texts.

Tasks cut the benchmark's items into stretches of normalised words, each word once, which overlap so that every window
lies in one of them. Every task gets the stretches and makes of them the sorted hashes of all windows, each with the
place of its words. It hashes all token windows of its texts with array operations, looks them up, and
verifies each hit word by word. Stretches that take more than ``BLOCK_BYTES`` are dealt into blocks, each
scanned on its own and its hits united per text, so what passes through the driver and is broadcast at once
has a fixed size.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import SLICE_BYTES, col, id_and_text, only_ids, stored, text_slices, trimmed
from tidemark.llm._hashing import LOWER, U, is_word_byte, prefix_sums, rolled, span_hashes, words_of

#: Words are runs of ASCII letters, digits and all bytes beyond ASCII.
WORD_BYTE = is_word_byte((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF), inside=True)
#: Bytes of normalised item words and item ids that one scan holds. A worker takes some four times as much for hashes and places, and twice that while it makes them.
BLOCK_BYTES = 64 << 20
#: Words of a stretch, besides those that it shares with the next.
STRETCH_WORDS = 4096
#: Leading bits of hashes that are asked first.
FILTER_BITS = 22


def _item_stretches(n: int):
    """(k, words, item): stretches of the words of each item, joined by spaces, that hold its windows of k words."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, _, data, offsets in text_slices(batch):
                data = LOWER[data]
                starts, ends, first = words_of(data, offsets, WORD_BYTE)
                joined, out = data.tobytes(), ([], [], [])
                for row in range(len(offsets) - 1):
                    a, b = int(first[row]), int(first[row + 1])
                    k = min(n, b - a)
                    for at in range(a, b - k + 1 if k else a, STRETCH_WORDS):
                        last = min(at + STRETCH_WORDS + k - 1, b)
                        out[0].append(k)
                        out[1].append(b" ".join(joined[s:e] for s, e in zip(starts[at:last].tolist(), ends[at:last].tolist())))
                        out[2].append(first_row + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), batch.column("item").take(pa.array(out[2], pa.int64()))],
                    names=["k", "words", "item"],
                )

    return run


def _hashed_windows(words: list[bytes], names: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, first byte, byte after the last, item) of the windows of stretches laid end to end, some stretches at a time."""
    done = first_row = 0
    sizes = np.cumsum([len(w) for w in words], dtype=np.int64)
    while first_row < len(words):
        last_row = max(first_row + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
        data = np.frombuffer(b"".join(words[first_row:last_row]), np.uint8)
        offsets = np.concatenate(([0], sizes[first_row:last_row] - done))
        starts, ends, first = words_of(data, offsets, WORD_BYTE)
        hashes = rolled(span_hashes(prefix_sums(data), starts, ends), length)
        stretch = np.searchsorted(first, np.arange(len(hashes)), "right") - 1
        at = np.flatnonzero(np.arange(len(hashes)) + length <= first[stretch + 1])
        begin, end = starts[at] + done, ends[at + length - 1] + done
        yield hashes[at], begin.astype(np.uint32), end.astype(np.uint32), names[first_row:last_row][stretch[at]]
        done, first_row = int(sizes[last_row - 1]), last_row


def _repeated(buffer: bytes, hashes: np.ndarray, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a window, in the order of hash and item, has the hash, item and words of the one before it."""
    again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (codes[1:] == codes[:-1])))
    for i in np.flatnonzero(again).tolist():
        again[i] = buffer[begin[i] : end[i]] == buffer[begin[i - 1] : end[i - 1]]
    return again


class WindowSet:
    """The windows of stretches: by length, their sorted hashes, the place of each in one buffer of words, and its item."""

    def __init__(self, table: pa.Table):
        self.of_length = {}
        k = table["k"].to_numpy()
        for length in np.unique(k).tolist():
            own = table.take(pa.array(np.flatnonzero(k == length)))
            items = own["item"].combine_chunks().dictionary_encode()
            names = items.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
            words = own["words"].to_pylist()
            buffer = b"".join(words)
            columns = [np.empty(sum(w.count(b" ") + 2 - length for w in words), t) for t in (U, np.uint32, np.uint32, np.int32)]
            done = 0
            for part in _hashed_windows(words, names, length):
                for column, some in zip(columns, part):
                    column[done : done + len(some)] = some
                done += len(part[0])
            del words, own
            at = np.lexsort((columns[3], columns[0])).astype(np.uint32)
            for i, column in enumerate(columns):  # one after another: no more than one is there twice
                columns[i] = column[at]
            kept = ~_repeated(buffer, columns[0], columns[3], columns[1], columns[2])
            if not kept.all():
                columns = [column[kept] for column in columns]
            known, begin, end, codes = columns
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[(known >> U(64 - FILTER_BITS)).astype(np.int64)] = True
            self.of_length[length] = known, np.packbits(seen), buffer, begin, end, codes, items.dictionary.to_pylist()

    def scan(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, str | None]]:
        """(first word, word after the last, item) of every verified occurrence in texts laid end to end."""
        if not len(starts):
            return
        hashes = span_hashes(prefix_sums(data), starts, ends)
        of_word = np.searchsorted(first, np.arange(len(starts)), "right")
        for length, (known, packed, buffer, begin, end, codes, names) in self.of_length.items():
            found = rolled(hashes, length)
            place = (found >> U(64 - FILTER_BITS)).astype(np.int64)
            at = np.flatnonzero((packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1)
            at = at[of_word[at] == of_word[at + length - 1]]
            i = np.minimum(np.searchsorted(known, found[at]), len(known) - 1)
            for w, k in zip(at[known[i] == found[at]], i[known[i] == found[at]]):
                words = b" ".join(data[starts[j] : ends[j]].tobytes() for j in range(w, w + length))
                while k < len(known) and known[k] == found[w]:
                    if buffer[begin[k] : end[k]] == words:
                        yield int(w), int(w) + length, names[codes[k]] if codes[k] >= 0 else None
                    k += 1


class Stretches:
    """Stretches on their way to the tasks, where they arrive as a WindowSet."""

    def __init__(self, table: pa.Table):
        self.table = table

    def __reduce__(self):
        return WindowSet, (self.table,)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


HITS = "n_words long, spans array<struct<first:int,last:int,from_byte:int,to_byte:int>>, items array<string>"
_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("from_byte", pa.int32()), ("to_byte", pa.int32())])


def _scanner(broadcast):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = broadcast.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for first_row, last_row, data, offsets in text_slices(batch):
                data = LOWER[data]
                starts, ends, first = words_of(data, offsets, WORD_BYTE)
                hits: dict[int, list] = defaultdict(list)
                for a, b, item in windows.scan(data, starts, ends, first):
                    hits[int(np.searchsorted(first, a, "right")) - 1].append((a, b, item))
                for row in range(last_row - first_row):
                    own = hits.get(row, ())
                    n_words.append(int(first[row + 1] - first[row]))
                    spans.append(
                        [
                            (int(a - first[row]), int(b - first[row]), int(starts[a] - offsets[row]), int(ends[b - 1] - offsets[row]))
                            for a, b in _merged([(a, b) for a, b, _ in own])
                        ]
                    )
                    items.append(sorted({item for *_, item in own if item is not None}))
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))],
                names=[*(c for c in batch.schema.names if c != "text"), "n_words", "spans", "items"],
            )

    return run


def _blocks(benchmark: DataFrame, n: int, block_bytes: int) -> Iterator[Stretches]:
    """The distinct stretches in blocks of about ``block_bytes``, each small enough for the driver."""
    stretches = stored(benchmark.mapInArrow(_item_stretches(n), "k int, words binary, item string").distinct(), "stretches")
    size = F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0))
    count = max(1, -(-(stretches.agg(F.sum(size)).first()[0] or 0) // block_bytes))
    block = F.pmod(F.xxhash64("words", "item"), F.lit(count))
    for i in range(count):
        yield Stretches(stretches.where(block == i).toArrow())


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 13,
    share: int = 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated, spans) of every row.

    Words are runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z. A window is n
    consecutive item words; an item of fewer words is one window, an item of none has none. Words
    inside any occurrence of a window are hit; spans are the maximal hit runs as word and byte ranges
    of the UTF-8 text. contaminated: n_hit > 0 and share * n_hit >= n_words.

    Null texts have no words, nor do null items; words in windows of an item without an id are hit, but it
    is not counted or named. Repeated rows repeat their result, also without an id; items that share an id
    count once, and an empty benchmark hits nothing. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.where(col(item_text_col).isNotNull()).select(col(item_col).cast("string").alias("item"), col(item_text_col).alias("text"))
    blocks = _blocks(items, n, block_bytes)
    now, following = next(blocks), next(blocks, None)
    texts = id_and_text(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()

    def scanned(source: DataFrame, block: Stretches) -> DataFrame:
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name != "text")
        return source.mapInArrow(_scanner(spark.sparkContext.broadcast(block)), f"{schema}, {HITS}")

    if following is None:
        found = scanned(texts, now)
    else:
        rows = stored(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
        parts = None
        while now is not None:
            part = stored(scanned(rows, now), "hits")
            parts = part if parts is None else parts.unionByName(part)
            now, following = following, next(blocks, None)
        found = parts.groupBy("row", "id").agg(
            F.max("n_words").alias("n_words"),
            F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        found = found.withColumn("spans", _united(F.col("spans")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    return found.select(
        F.col("id").cast(kind).alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )


def _united(spans):
    """Sorted spans, those that touch or overlap made one."""
    empty = F.array().cast("array<struct<first:int,last:int,from_byte:int,to_byte:int>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["first"].alias("first"),
            F.greatest(last["last"], span["last"]).alias("last"),
            last["from_byte"].alias("from_byte"),
            F.greatest(last["to_byte"], span["to_byte"]).alias("to_byte"),
        )
        touches = (F.size(done) > 0) & (span["first"] <= F.try_element_at(done, F.lit(-1))["last"])
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, add)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose own text is not contaminated, with or without an id."""
    whole = F.struct(*map(col, docs.columns)).alias("whole")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), whole), "rows")
    texts = rows.select("row", F.col("whole").getField(text_col).alias("text"))
    found = contamination(texts, benchmark, "row", "text", **options)
    bad = stored(found.where("contaminated").select("doc_id"), "contaminated")
    return only_ids(rows, "row", bad, "left_anti").select("whole.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text) with every hit byte range cut out of the text, ids being unique."""
    found = contamination(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("id"), "spans")
    texts = id_and_text(docs, id_col, text_col).join(found, "id", "left")
    body = F.encode("text", "UTF-8")
    ends = F.concat(F.array(F.lit(0)), F.col("spans")["to_byte"])
    begins = F.concat(F.col("spans")["from_byte"], F.array(F.octet_length("text")))
    pieces = F.zip_with(ends, begins, lambda a, b: F.decode(F.substring(body, a + 1, b - a), "UTF-8"))
    return texts.select(F.col("id").alias("doc_id"), F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(F.col("text")).alias("text"))
