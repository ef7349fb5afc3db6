"""Suffix-array dedup: removes bytes that lie in a long string which also starts elsewhere.

A full suffix array would shuffle every suffix with hundreds of bytes. Here a suffix enters at an
anchor that its own content chooses: of the short grams inside a window of ``length`` bytes, the one
with the smallest hash. Equal windows have the same anchor at the same place, so

1. anchors of a text that follow each other at one distance amid the same bytes, as in a run of one letter or a
   row of equal lines, become one, whose windows are known to repeat. All anchors are counted by gram, and
   those whose gram occurs once are done: no other window is the same;
2. of the rest, the bytes that their windows cover go to buckets, range-partitioned by the leading
   bytes of the suffix at the anchor between sampled splitters. Suffixes with the same lead are never
   parted by a splitter, so that no repeat lies across a boundary;
3. a bucket sorts the suffixes by multikey quicksort on their bytes, and in the same way what precedes
   their anchors, read backwards. The common prefixes of neighbours in both orders tell which
   suffixes agree how far to either side, hence which windows are the same bytes;
4. a lead that very many suffixes share is dealt over several buckets. Windows that are alone in theirs
   are compared across those buckets by 128-bit cryptographic digests;
5. marked windows are united per document and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import id_and_text, spread_join, stored, text_slices, trimmed
from tidemark.llm._hashing import U, prefix_sums, span_hashes

GRAM = 32
#: Windows of a text whose anchors are chosen at once.
BLOCK_WINDOWS = 1 << 18
#: Suffixes with the same lead that one bucket compares.
BUCKET_ROWS = 4096
#: Suffixes below which the sort compares whole strings instead of partitioning further.
FEW = 24
_PLACE = U(0xFFFFFFFF)


def _block_anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, first window start, last window start) of each anchor of a stretch of bytes.

    The anchor of the window that starts at s is its gram of smallest hash, the leftmost of equals.
    """
    windows, width = len(data) - length + 1, length - gram + 1
    at = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix_sums(data), at, at + gram)
    keyed = np.full(-(-len(at) // width) * width, np.iinfo(U).max, U)
    keyed[: len(at)] = (hashes & ~_PLACE) | at.astype(U)
    blocks = keyed.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _PLACE).astype(np.int64)
    change = np.flatnonzero(place[1:] != place[:-1]) + 1
    low, high = np.concatenate(([0], change)), np.concatenate((change - 1, [windows - 1]))
    return hashes[place[low]], place[low], low, high


def _collapsed(data: np.ndarray, found: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, ...]:
    """Anchors of a stretch, those that follow each other at one distance with the same bytes around them made one.

    Adds how many there were and their distance: windows of such anchors repeat inside the stretch.
    """
    gram, place, low, high = found
    step = np.diff(place)
    alike = (gram[1:] == gram[:-1]) & (np.diff(low) == step) & (np.diff(high) == step)
    # of each run of neighbours at one distance: bytes that differ from those a distance on
    edge = np.flatnonzero(np.concatenate(([True], ~alike[1:] | ~alike[:-1] | (step[1:] != step[:-1]))) & alike) if len(alike) else alike
    for first in edge:
        last = first
        while last < len(alike) and alike[last] and step[last] == step[first]:
            last += 1
        begin, end, by = low[first], high[last - 1] + length, step[first]
        unlike = np.concatenate(([0], np.cumsum(data[begin:end] != data[begin + by : end + by])))
        alike[first:last] = unlike[high[first:last] + length - begin] == unlike[low[first:last] - begin]
    follows = np.concatenate(([False], alike))
    same_step = np.concatenate(([True, True], step[1:] == step[:-1]))[: len(follows)]
    follows &= same_step | ~np.concatenate(([False], follows[:-1]))
    kept = np.flatnonzero(~follows)
    times = np.diff(np.append(kept, len(follows)))
    by = np.where(times > 1, np.append(step, 0)[kept], 0)
    return gram[kept], place[kept], low[kept], high[kept], times, by


def anchors(data: np.ndarray, length: int, gram: int = GRAM, block: int = BLOCK_WINDOWS) -> tuple[np.ndarray, ...]:
    """(gram hash, place, first window start, last window start, times, step) of each anchor of one text.

    ``times`` anchors that follow each other ``step`` bytes apart with the same windows are one row, for the first.
    Made block by block, so that memory does not follow the text.
    """
    windows = len(data) - length + 1
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(U), none, none, none, none, none
    parts: list[tuple[np.ndarray, ...]] = []
    for first in range(0, windows, block):
        part = data[first : min(first + block, windows) + length - 1]
        found = _collapsed(part, _block_anchors(part, length, gram), length)
        found = (found[0], *(x + first for x in found[1:4]), *found[4:])
        if parts and parts[-1][1][-1] == found[1][0] and parts[-1][4][-1] == found[4][0] == 1:
            parts[-1][3][-1] = found[3][0]
            found = tuple(x[1:] for x in found)
        if len(found[0]):
            parts.append(found)
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(6))


def _anchor_rows(length: int, gram: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, _, data, offsets in text_slices(batch):
                rows, parts = [], []
                for i in range(len(offsets) - 1):
                    found = anchors(data[offsets[i] : offsets[i + 1]], length, gram)
                    parts.append(found)
                    rows.append(np.full(len(found[0]), first_row + i))
                columns = [np.concatenate([p[k] for p in parts]) for k in range(6)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(np.concatenate(rows))),
                        pa.array(columns[0].view(np.int64)),
                        *(pa.array(c.astype(np.int32)) for c in columns[1:]),
                    ],
                    names=["id", "gram", "place", "low", "high", "times", "step"],
                )

    return run


def _suffixes(length: int, gram: int):
    """The bytes around each anchor; equal ones of a document make one row with all their starts."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, size = [], ([], [], [], [], [], [], []), 0

            def made():
                types = (pa.binary(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.bool_())
                return pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(out, types))],
                    names=["id", "lead", "salt", "shared", "starts", "place", "body", "again"],
                )

            for row, (text, found) in enumerate(zip(batch.column("text"), batch.column("anchors"))):
                data = text.as_py().encode()
                same: dict[tuple, list[int]] = {}
                again = set()
                for a in found.as_py():
                    body = data[a["low"] : a["high"] + length]
                    key = body, a["place"] - a["low"], a["salt"], a["shared"]
                    same.setdefault(key, []).append(a["low"])
                    if a["again"]:
                        again.add(key)
                for key, starts in same.items():
                    body, place, salt, shared = key
                    rows.append(row)
                    for column, value in zip(out, (body[place : place + gram], salt, shared, starts, place, body, key in again)):
                        column.append(value)
                    size += len(body)
                if size > 8 << 20:
                    yield made()
                    rows, out, size = [], ([], [], [], [], [], [], []), 0
            yield made()

    return run


def multikey_quicksort(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of strings by their first ``width`` bytes: common[i] bytes are those that the i-th
    string in order shares with the one before it, -1 for the first.

    Keys are words of eight bytes: a part is split in three by the word of a pivot at its depth, and only
    the middle part, which shares that word, goes on to the next.
    """
    words = -(-width // 8)
    sizes = np.array([min(len(s), width) for s in strings])
    table = np.zeros((len(strings), 8 * words), np.uint8)
    for row, string in zip(table, strings):
        part = string[:width]
        row[: len(part)] = np.frombuffer(part, np.uint8)
    keys = table.view(">u8").astype(U)
    order, todo = np.arange(len(strings)), [(0, len(strings), 0)]
    while todo:
        low, high, depth = todo.pop()
        rows = order[low:high]
        if high - low <= FEW:
            if high - low > 1:
                order[low:high] = sorted(rows.tolist(), key=lambda r: strings[r][:width])
            continue
        if depth == words:
            order[low:high] = rows[np.argsort(sizes[rows], kind="stable")]
            continue
        key = keys[rows, depth]
        pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
        less, more = key < pivot, key > pivot
        middle = low + int(less.sum()), high - int(more.sum())
        if middle == (low, high):
            same = (keys[rows, depth:] == keys[rows[0], depth:]).all(0)
            todo.append((low, high, words if same.all() else depth + int(same.argmin())))
            continue
        order[low:high] = np.concatenate((rows[less], rows[~(less | more)], rows[more]))
        todo += [(low, middle[0], depth), (middle[0], middle[1], depth + 1), (middle[1], high, depth)]
    unlike = table[order[1:]] != table[order[:-1]]
    common = np.where(unlike.any(1), unlike.argmax(1), width)
    common = np.minimum(common, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return order, np.concatenate(([-1], common))


def repeated_windows(bodies: list[bytes], places: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each offset of anchors in windows: (offset, rows with such a window, the class of each, how many are in a class).

    Windows of a class are the same bytes: their rows agree up to the window's end in the one order and
    back to its start in the other.
    """
    right, after = multikey_quicksort([b[p:] for b, p in zip(bodies, places)], length)
    left, before = multikey_quicksort([b[:p][::-1] for b, p in zip(bodies, places)], length)
    of_right, of_left = np.argsort(right), np.argsort(left)
    least = np.maximum(0, places - (np.array([len(b) for b in bodies]) - length))
    for offset in range(int(least.min()), int(places.max()) + 1):
        rows = np.flatnonzero((least <= offset) & (offset <= places))
        if len(rows):
            ahead = np.cumsum(after < length - offset)[of_right[rows]]
            behind = np.cumsum(before < offset)[of_left[rows]]
            _, of_class, count = np.unique(ahead * len(bodies) + behind, return_inverse=True, return_counts=True)
            yield offset, rows, of_class, count


def _repeats(length: int, id_type: pa.DataType):
    """Byte ranges of repeated windows; of shared leads also a row for each distinct window with its digest."""

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        bodies, places = [r[6] for r in rows], np.array([r[5] for r in rows])
        n = np.array([len(b) for b in bodies]) - length + 1
        first = np.cumsum(n) - n
        row = np.repeat(np.arange(len(rows)), n)
        place = np.arange(n.sum()) - first[row]
        several, shared = np.array([len(r[4]) > 1 or r[7] for r in rows]), np.array([r[3] for r in rows])
        double, singles = np.zeros(len(row), bool), []
        for offset, at, of_class, count in repeated_windows(bodies, places, length):
            repeats = (count[of_class] > 1) | several[at]
            double[first[at] + places[at] - offset] = repeats
            if shared[at].any():
                in_class = np.zeros(len(count), bool)
                in_class[of_class[repeats]] = True
                one = np.unique(of_class, return_index=True)[1]
                singles += [(at[k], places[at[k]] - offset, in_class[of_class[k]]) for k in one[shared[at[one]]]]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], double.astype(np.int8), [0]))) != 0)
        cut = np.concatenate((edge, first, first + n))
        cut = np.unique(cut[cut < len(double)])
        cut_end = np.concatenate((cut[1:], [len(double)]))
        ids, start, end, digest, known = [], [], [], [], []
        for a, b in zip(cut[double[cut]], cut_end[double[cut]]):
            r = rows[row[a]]
            for s in r[4]:
                ids.append(r[0])
                start.append(s + int(place[a]))
                end.append(s + int(place[b - 1]) + length)
        digest += [None] * len(ids)
        known += [True] * len(ids)
        for w, at, in_class in singles:
            r = rows[w]
            ids.append(r[0])
            start.append(r[4][0] + int(at))
            end.append(r[4][0] + int(at) + length)
            digest.append(hashlib.blake2b(bodies[w][at : at + length], digest_size=16).digest())
            known.append(bool(in_class))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(digest, pa.binary()), pa.array(known, pa.bool_())],
            names=["id", "start", "end", "window", "known"],
        )

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, now = [], 0, None
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("id", "lead", "salt", "shared", "starts", "place", "body", "again"))):
                if size > 1 << 20 and (r[1], r[2]) != now:
                    yield compared(rows)
                    rows, size = [], 0
                now = r[1], r[2]
                rows.append(r)
                size += len(r[6])
        if rows:
            yield compared(rows)

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_bytes, n_removed, n_spans, digests, spans = [], [], [], [], []
        for text, found in zip(batch.column("text"), batch.column("ranges")):
            data = text.as_py().encode()
            runs: list[list[int]] = []
            for s in sorted((x["start"], x["end"]) for x in found.as_py() or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            kept, at = hashlib.sha256(), 0
            for a, b in runs:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            n_bytes.append(len(data))
            n_removed.append(sum(b - a for a, b in runs))
            n_spans.append(len(runs))
            digests.append(kept.hexdigest())
            spans.append([{"start": a, "end": b} for a, b in runs])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)),
                pa.array(digests, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row.

    Texts are UTF-8 bytes. Every byte in a string of ``length`` bytes that starts at another place too,
    of this or another row, is removed; spans are the maximal removed runs, kept_sha256 digests what
    is left. Strings are compared byte by byte, but for those at leads that more than ``bucket_rows``
    suffixes share, which are also compared by 128-bit digests.

    Null text counts as empty. Repeated rows are documents of their own, so long ones repeat each
    other; ids may be null or shared. An empty table gives an empty result. Other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    texts = id_and_text(docs, id_col, text_col)
    count = texts.agg(F.count("*"), F.count_distinct("id")).first()
    own_ids = count[0] == count[1]
    if not own_ids:
        texts = stored(texts.select(F.monotonically_increasing_id().alias("id"), F.col("id").alias("name"), "text"), "rows")
    kind = texts.schema["id"].dataType
    name = kind.simpleString()
    gram = min(GRAM, length)

    bodies = texts.select("id", "text")
    found = stored(bodies.mapInArrow(_anchor_rows(length, gram), f"id {name}, gram long, place int, low int, high int, times int, step int"), "anchors")
    repeated = stored(found.groupBy("gram").count().where("count > 1"), "grams")
    joined = spread_join(found, repeated, ["gram"], "count")
    parts = F.ceil(F.col("count") / bucket_rows).cast("int")
    chosen = joined.select(
        "id", F.struct("place", "low", "high", F.pmod(F.xxhash64("id"), parts).cast("int").alias("salt"), (parts > 1).alias("shared"), (F.col("times") > 1).alias("again")).alias("anchor")
    )
    chosen = stored(chosen.groupBy("id").agg(F.collect_list("anchor").alias("anchors")), "chosen")

    suffixes = bodies.join(chosen, "id").mapInArrow(
        _suffixes(length, gram), f"id {name}, lead binary, salt int, shared boolean, starts array<int>, place int, body binary, again boolean"
    )
    sorted_suffixes = suffixes.repartitionByRange("lead", "salt").sortWithinPartitions("lead", "salt")
    ranges = sorted_suffixes.mapInArrow(_repeats(length, to_arrow_type(kind)), f"id {name}, start int, end int, window binary, known boolean")
    ranges = stored(ranges, "ranges")
    alone = ranges.where("window is not null")
    across = alone.groupBy("window").count().where("count > 1").select("window")
    across = alone.where("not known").join(across, "window", "left_semi")
    inside = found.where("times > 1").select("id", F.col("low").alias("start"), (F.col("high") + length + (F.col("times") - 1) * F.col("step")).alias("end"))
    removed = ranges.where("window is null").select("id", "start", "end").unionByName(across.select("id", "start", "end")).unionByName(inside)
    removed = stored(removed.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "removed")

    result = bodies.join(removed, "id", "left").mapInArrow(
        _cut_out, f"id {name}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"
    )
    if not own_ids:
        result = result.join(texts.select("id", "name"), "id").drop("id").withColumnRenamed("name", "id")
    return result.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
