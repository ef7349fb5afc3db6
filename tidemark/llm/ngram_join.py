"""N-gram Jaccard join: size-banded tiles, bitmap bounds, then exact sorted-array intersection.

How no link is lost without comparing all pairs:

* Texts with equal shingle sets collapse into one class. Only classes are joined.
* A set is sorted by the hashes of its shingles. Its keys are the first m runs of ``r`` neighbours in that
  order. A shingle that only this set has spoils r of its runs, one that only the other has lies inside
  r - 1 of them. Of two sets of Jaccard similarity t or more, with r <= 1 / (1 - t), a set of n shingles
  has at most r (1 - t) n spoilt runs. With m one more than that, some run among the first m of both is
  the same: take the set whose m runs end first in the common order. So linked sets always share a key.
  Sets too small to have m runs, and those that may link with such a set, emit the keys of a prefix filter
  as well: the first n - tn + 1 shingles.
* Sets of a batch that share a key are combined before the shuffle: the smallest stands for them, so that
  a key that very many sets have arrives as one row a batch.
* Sets that share a key are candidates. First each is compared with the set that stands for it, and those with
  the smallest of all; linked sets merge. Sets whose keys are still split over several components go on to
  tiles, one for each smallest set and band of sizes, in which bitmap bounds leave few pairs: one pass that stops at
  the first possible partner, and one over all remaining pairs. Very large tiles are dealt over several tasks.
* Band edges grow by 1/t, so that linked sets lie in one band or in two neighbours. The tile of a band
  holds pairs whose smaller set is of that band.
* A bitmap has a bit for the hash of each shingle. Bits that only one of two bitmaps has count
  shingles that only one set has, which bounds the intersection from above.
* Shingles are compared by 64-bit hashes under bases drawn for each run, so that no text can be made to collide.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._common import id_and_text, only_ids, stored, text_slices, trimmed
from tidemark.llm._hashing import LOWER, STEP, U, is_word_byte, keyed_spans, mix, rolled, secret_bases, words_of
from tidemark.llm.components import connected_components

#: Words are runs of bytes other than ASCII white space.
WORD_BYTE = is_word_byte((0x20, 0x20), (0x09, 0x0D), inside=False)
#: Neighbours in a run, at most.
RUN = 2
#: Keys of one batch that are combined before they are sent.
BATCH_KEYS = 1 << 18
#: Bits of a bitmap for each shingle, and at most: at this load bounds are within a few hundredths of the truth.
BITS_PER_SHINGLE = 16
MOST_BITS = 1 << 16
#: Sets of one tile that are compared in one task.
TILE_ROWS = 2048


def band_edges(percent: int, largest: int) -> list[int]:
    """The smallest size of each band, up to the band of ``largest``."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, ceil(edges[-1] * 100 / percent)))
    return edges


class Keys:
    """The keys of sets for a threshold in per cent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.run = max(r for r in range(1, RUN + 1) if r * (100 - percent) < 100)
        self.least = 1
        while not self._has_runs(self.least):
            self.least += 1

    def _spoilt(self, n: int) -> int:
        return self.run * (100 - self.percent) * n // 100

    def _has_runs(self, n: int) -> bool:
        """Whether a set of n shingles, and so any larger one, has more runs than can be spoilt."""
        return n - self.run >= self._spoilt(n)

    def of(self, sorted_set: np.ndarray) -> np.ndarray:
        n, out = len(sorted_set), []
        if n >= self.least:
            out.append(rolled(sorted_set[: self._spoilt(n) + self.run], self.run))
        smallest_partner = ceil(self.percent * n / 100)
        if smallest_partner < self.least:
            out.append(mix(sorted_set[: n - smallest_partner + 1] ^ U(0xE7037ED1A0B428DB)))
        return np.concatenate(out)


def _bitmap(sorted_set: np.ndarray) -> bytes:
    bits = min(MOST_BITS, max(64, 1 << (BITS_PER_SHINGLE * len(sorted_set) - 1).bit_length()))
    flags = np.zeros(bits, bool)
    flags[(sorted_set & U(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _shingle_sets(batch: pa.RecordBatch, words: int, bases: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of the batch."""
    for first_row, last_row, data, offsets in text_slices(batch):
        data = LOWER[data]
        starts, ends, first = words_of(data, offsets, WORD_BYTE)
        hashes = keyed_spans(data, starts, ends, bases)
        shingles = rolled(hashes, words)
        for row in range(last_row - first_row):
            a, b = first[row], first[row + 1]
            if b - a >= words:
                yield first_row + row, np.unique(shingles[a : b - words + 1])
            elif b > a:
                yield first_row + row, rolled(hashes[a:b], b - a)
            else:
                yield first_row + row, np.zeros(0, U)


def _sketch(words: int, bases: tuple[int, int]):
    """The size and two sums of the shingle hashes of each text, which tell its class."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two = [], [], []
            for _, found in _shingle_sets(batch, words, bases):
                n.append(len(found))
                one.append(int(mix(found).sum(dtype=U).view(np.int64)))
                two.append(int(mix(found ^ U(STEP)).sum(dtype=U).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, pa.int64()) for c in (n, one, two))], names=["id", "n", "one", "two"])

    return run


def _keyed(words: int, percent: int, bases: tuple[int, int], batch_keys: int):
    """(key, via, rep): the smallest set of a batch with a key, with via null, and the others with it as via."""

    def combined(reps: list[int], keys: list[np.ndarray]) -> pa.RecordBatch:
        key, rep = np.concatenate(keys).view(np.int64), np.repeat(np.array(reps, np.int64), [len(k) for k in keys])
        order = np.lexsort((rep, key))
        key, rep = key[order], rep[order]
        again = np.concatenate(([False], (key[1:] == key[:-1]) & (rep[1:] == rep[:-1])))
        key, rep = key[~again], rep[~again]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        via = rep[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(via, mask=first), pa.array(rep)], names=["key", "via", "rep"])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, reps, keys, size = Keys(percent).of, [], [], 0
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for row, found in _shingle_sets(batch, words, bases):
                if len(found):
                    reps.append(ids[row])
                    keys.append(of(found))
                    size += len(keys[-1])
                    if size >= batch_keys:
                        yield combined(reps, keys)
                        reps, keys, size = [], [], 0
        if keys:
            yield combined(reps, keys)

    return run


def _sets(words: int, bases: tuple[int, int]):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                piece = batch.slice(part, 256)
                found = [s for _, s in _shingle_sets(piece, words, bases)]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([_bitmap(s) if len(s) else b"" for s in found], pa.binary()),
                        pa.array([s.astype("<u8").tobytes() for s in found], pa.binary()),
                    ],
                    names=["id", "n", "bitmap", "shingles"],
                )

    return run


def _enough(both: int | np.ndarray, a: int | np.ndarray, b: int | np.ndarray, percent: int):
    return 100 * both >= percent * (a + b - both)


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    """The bitmap of the same set with fewer bits."""
    return np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, size // 8), axis=0)


def _possible(a: tuple[int, bytes], b: tuple[int, bytes], percent: int) -> bool:
    size = min(len(a[1]), len(b[1]))
    x, y = _folded(a[1], size), _folded(b[1], size)
    both = min(a[0] - int(np.bitwise_count(x & ~y).sum()), b[0] - int(np.bitwise_count(y & ~x).sum()))
    return bool(_enough(both, a[0], b[0], percent))


def _bounded_pairs(percent: int):
    """Keeps pairs whose bitmaps allow a link."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            keep = [_possible((n, p), (m, q), percent) for n, p, m, q in zip(x["n_a"], x["bitmap_a"], x["n_b"], x["bitmap_b"])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked_pairs(percent: int):
    """Keeps pairs whose shingle sets reach the threshold, by intersecting the sorted arrays."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                p, q = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
                keep.append(bool(_enough(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _tile_pairs(percent: int, every: bool):
    """Pairs of one tile that share a key, are in different components, and that bitmaps allow; the smaller set is in the tile's band.

    Rows come sorted by tile. ``every``: all such pairs; else a set that found a possible partner is
    not compared further, so that a tile of m near copies gives m pairs and not their square.
    """

    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        if len({r[2] for r in rows}) < 2:
            return
        rows.sort(key=lambda r: (r[3], r[1]))
        ids, names, sizes, side, in_band = (np.array([r[i] for r in rows]) for i in (1, 2, 3, 6, 7))
        width = min(len(r[4]) for r in rows)
        maps = np.stack([_folded(r[4], width) for r in rows])
        _, code = np.unique(np.concatenate([r[5] for r in rows]), return_inverse=True)
        codes = np.split(code, np.cumsum([len(r[5]) for r in rows])[:-1])
        holder = np.repeat(np.arange(len(rows)), [len(c) for c in codes])[np.argsort(code, kind="stable")]
        first = np.concatenate(([0], np.cumsum(np.bincount(code))))
        free = np.ones(len(rows), bool)
        for i in range(len(rows)):
            if not in_band[i] or (not every and not free[i]):
                continue
            sharing = np.zeros(len(rows), bool)
            for c in codes[i]:
                sharing[holder[first[c] : first[c + 1]]] = True
            last = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
            sharing[: i + 1] = sharing[last:] = False
            sharing &= (names != names[i]) & ((side != side[i]) | (side < 0))
            j = np.flatnonzero(sharing if every else sharing & free)
            for block in np.array_split(j, len(j) // 512 + 1):
                only_i = sizes[i] - np.bitwise_count(maps[i] & ~maps[block]).sum(1, dtype=np.int64)
                only_j = sizes[block] - np.bitwise_count(maps[block] & ~maps[i]).sum(1, dtype=np.int64)
                hit = block[_enough(np.minimum(only_i, only_j), sizes[i], sizes[block], percent)]
                free[hit] = False
                for k in hit:
                    yield int(min(ids[i], ids[k])), int(max(ids[i], ids[k]))

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            now, rows = None, []
            for batch in batches:
                lists = batch.column("keys")
                at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
                keys = [values[a:b].copy() for a, b in zip(at[:-1], at[1:])]
                others = (batch.column(c).to_pylist() for c in ("tile", "id", "component", "n", "bitmap"))
                for row in zip(*others, keys, batch.column("side").to_pylist(), batch.column("in_band").to_pylist()):
                    if row[0] != now:
                        yield rows
                        now, rows = row[0], []
                    rows.append(row)
            yield rows

        found: list[tuple[int, int]] = []
        for rows in groups():
            for pair in pairs(rows):
                found.append(pair)
                if len(found) >= 10_000:
                    yield _pair_batch(found)
                    found = []
        yield _pair_batch(found)

    return run


def _pair_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def ngram_jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A text's set holds its distinct shingles of ``words`` words (lower-cased A-Z, split at ASCII white
    space); a shorter text is one shingle, a text without words has none and links to nothing. Two texts link
    when 100 * |intersection| >= percent * |union|; component_id is the smallest id reachable by
    links, itself included.

    Null text counts as empty. A row without an id gets its n_shingles, links to nothing and has a
    null component. Repeated rows repeat their result; texts that share an id are one node. An empty
    table gives an empty result. Other columns are ignored.
    """
    texts, bases = id_and_text(docs, id_col, text_col), secret_bases()
    sketches = stored(texts.mapInArrow(_sketch(words, bases), "id long, n long, one long, two long"), "sketches")
    named = sketches.where("id is not null and n > 0")
    classes = stored(named.groupBy("one", "two", "n").agg(F.min("id").alias("rep")), "classes")
    reps = only_ids(texts, "id", stored(classes.select("rep").distinct(), "representatives"))
    of_key = Window.partitionBy("key", "via")
    met = reps.mapInArrow(_keyed(words, percent, bases, BATCH_KEYS), "key long, via long, rep long")
    met = met.withColumns({"pivot": F.min("rep").over(of_key), "last": F.max("rep").over(of_key)}).where("via is not null or pivot < last")
    met = stored(met.select("key", "via", "rep", "pivot"), "met")
    top = met.where("via is null")
    below = met.where("via is not null").select("key", "via", "rep").join(top.select("key", F.col("rep").alias("via"), F.col("pivot").alias("tile")), ["key", "via"], "left")
    shared = top.select(F.col("pivot").alias("tile"), F.col("pivot").alias("via"), "rep", "key").unionByName(
        below.select(F.coalesce("tile", "via").alias("tile"), "via", "rep", "key")
    )
    shared = stored(shared.groupBy("tile", "rep").agg(F.collect_set("key").alias("keys"), F.collect_set("via").alias("vias")), "shared_keys")
    first = shared.select(F.explode("vias").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()
    candidates = stored(shared.select("rep").union(shared.select("tile")).union(first.select("a")).distinct(), "candidates")
    sets = only_ids(texts, "id", candidates).mapInArrow(_sets(words, bases), "id long, n long, bitmap binary, shingles binary").where("n > 0")
    sets = stored(sets, "sets")

    twice = named.groupBy("id").agg(F.min("one").alias("x"), F.max("one").alias("y")).where("x <> y").select("id")
    edges = (
        named.join(twice, "id").join(classes, ["one", "two", "n"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )
    components = checked = None
    for every in (None, False, True):
        if every is None:
            pairs = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            tiles = _tiles(shared, components, sets, percent)
            if tiles.isEmpty():
                break
            pairs = _dealt(tiles, sets).mapInArrow(_tile_pairs(percent, every), "a long, b long").distinct().join(checked, ["a", "b"], "left_anti")
        pairs = pairs.join(_side(sets, "a", "n", "bitmap"), "a").join(_side(sets, "b", "n", "bitmap"), "b")
        pairs = stored(pairs.mapInArrow(_bounded_pairs(percent), "a long, b long"), "pairs")
        checked = pairs if checked is None else checked.unionByName(pairs)
        ones, others = (_needed(sets, pairs, side) for side in ("a", "b"))
        links = pairs.join(_side(ones, "a", "shingles"), "a").join(_side(others, "b", "shingles"), "b")
        links = links.mapInArrow(_linked_pairs(percent), "a long, b long")
        components = stored(connected_components(edges.unionByName(links)), "components")
        edges = components.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))

    of_class = classes.join(components, classes["rep"] == components["node"], "left").select(
        "one", "two", "n", F.coalesce("component", "rep").alias("component")
    )
    return (
        sketches.select("id", "n", "one", "two")
        .join(of_class, ["one", "two", "n"], "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
    )


def _tiles(shared: DataFrame, components: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(tile, band, in_band, id, n, component, keys, members) of tiles whose sets are in several components.

    A set goes to the tile of its own band and, as the larger one of pairs, to that of the band below.
    """
    largest = sets.agg(F.max("n")).first()[0] or 1
    edges = F.array(*map(F.lit, band_edges(percent, largest)))
    band = F.size(F.filter(edges, lambda e: e <= F.col("n")))
    known = shared.join(components.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumnRenamed("rep", "id")
    known = known.join(sets.select("id", "n"), "id").withColumn("own_band", band).withColumn("band", F.explode(F.array(F.col("own_band"), F.col("own_band") - 1)))
    known = known.select("tile", "band", (F.col("band") == F.col("own_band")).alias("in_band"), "id", "n", F.coalesce("component", "id").alias("component"), "keys")
    mixed = known.groupBy("tile", "band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("members"))
    return stored(known.join(mixed.where("x < y").select("tile", "band", "members"), ["tile", "band"]), "tiles")


def _dealt(tiles: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of each tile together, sorted; a large tile is dealt over several, which hold each pair of its parts."""
    parts = F.ceil(F.col("members") / TILE_ROWS).cast("int")
    own, other = F.col("own"), F.col("other")
    rows = tiles.withColumn("own", F.pmod(F.xxhash64("id"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.join(sets.select("id", "bitmap"), "id").select(
        F.xxhash64("tile", "band", F.least(own, other), F.greatest(own, other)).alias("tile"),
        "id",
        "component",
        "n",
        "bitmap",
        "keys",
        F.when(own == other, -1).otherwise(own).alias("side"),
        "in_band",
    )
    return rows.repartition("tile").sortWithinPartitions("tile")


def _needed(sets: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """The sets that one side of the pairs names: no other set's shingles are sent."""
    return only_ids(sets, "id", stored(pairs.select(side).distinct(), "named"))


def _side(table: DataFrame, name: str, *columns: str) -> DataFrame:
    return table.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose id names their component; rows without an id stay."""
    found = ngram_jaccard_groups(docs, id_col, text_col, **options)
    dropped = stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "near_copies")
    return only_ids(docs, id_col, dropped, "left_anti")
