"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products.

A text becomes counts of hashed n-grams of two views of its words: the words themselves (lower-cased)
and their shapes (upper or lower case, digits, which symbols), with marks where a word repeats the one
before or one of the last few. Training runs FTRL-proximal updates, one text at a time, over a bounded
sample of labelled rows in one task; the weights, ``2**BITS`` floats, are all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import col, id_and_text, stored, text_slices, trimmed
from tidemark.llm._hashing import LOWER, STEP, U, mix, prefix_sums, span_hashes, words_of

BITS = 18
#: Labelled rows that training sees at most, those with the smallest hashes of their ids.
SAMPLE_ROWS = 8_000
#: Updates that training makes about, going over a small sample several times (at most 12).
UPDATES = 24_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_UPPER, _LOWERCASE, _DIGIT, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_UPPER[0x41:0x5B] = True
_LOWERCASE[0x61:0x7B] = True
_DIGIT[0x30:0x3A] = True
_SYMBOL[:0x80] = True
_SYMBOL[:0x80] &= ~(_SPACE | _UPPER | _LOWERCASE | _DIGIT)[:0x80]


def _runs(data: np.ndarray, offsets: np.ndarray):
    """Words: runs of symbols, and runs of everything else between white space and symbols."""
    s1, e1, _ = words_of(data, offsets, ~(_SPACE | _SYMBOL))
    s2, e2, _ = words_of(data, offsets, _SYMBOL)
    starts, ends = np.concatenate((s1, s2)), np.concatenate((e1, e2))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    return starts, ends, np.searchsorted(starts, offsets)


def _count(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[ends] - sums[starts]


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, values) of each text: unit-length vectors of damped n-gram counts; index 0 is the bias."""
    starts, ends, first = _runs(data, offsets)
    if len(starts):
        words = span_hashes(prefix_sums(LOWER[data]), starts, ends)
        length = ends - starts
        symbol = _SYMBOL[data[starts]]
        upper, lower, digit = (_count(t[data], starts, ends) for t in (_UPPER, _LOWERCASE, _DIGIT))
        shape = (upper > 0) * 1 + (upper == length) * 2 + (lower > 0) * 4 + (digit > 0) * 8 + np.minimum(length, 12) // 4 * 16
        text = np.searchsorted(first, np.arange(len(words)), "right")  # words of other texts in the slice say nothing
        glued = np.concatenate(([False], (starts[1:] == ends[:-1]) & (text[1:] == text[:-1])))
        repeats = np.zeros(len(words), np.int64)
        for back in (4, 3, 2, 1):
            repeats[back:][(words[back:] == words[:-back]) & ~symbol[back:] & (text[back:] == text[:-back])] = back
        shape = np.where(symbol, mix(words), (shape + 64 * repeats).astype(U)) + glued.astype(U) * U(STEP)
        shape = mix(shape)
        views = [words ^ U(1), shape ^ U(2), np.zeros(len(words), U), np.zeros(len(words), U), np.zeros(len(words), U)]
        views[2][1:] = words[1:] * U(STEP) + words[:-1] + U(3)
        views[3][1:] = shape[1:] * U(STEP) + shape[:-1] + U(4)
        views[4][2:] = (shape[2:] * U(STEP) + shape[1:-1]) * U(STEP) + shape[:-2] + U(5)
        hashed = [(mix(v) >> U(64 - bits)).astype(np.int64) for v in views]
    for row in range(len(offsets) - 1):
        a, b = first[row], first[row + 1]
        if a == b:
            yield np.zeros(1, np.int64), np.ones(1)
            continue
        parts = [hashed[0][a:b], hashed[1][a:b], hashed[2][a + 1 : b], hashed[3][a + 1 : b], hashed[4][a + 2 : b]]
        index, counts = np.unique(np.concatenate(parts), return_counts=True)
        value = np.log1p(counts)
        value /= np.sqrt(value @ value)
        yield np.concatenate(([0], index)), np.concatenate(([1.0], value * 4))


def _featured(bits: int):
    """The features of each text as packed indexes and values: no more than one number for each coordinate, however long it is."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                made = list(features(data, offsets, bits))
                part = batch.slice(first, last - first)
                index, value = (pa.array([x[i].astype(t).tobytes() for x in made], pa.binary()) for i, t in ((0, "<i4"), (1, "<f8")))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), part.column("mark"), index, value], names=["id", "label", "mark", "index", "value"])

    return run


def _train(bits: int, alpha: float, beta: float, l1: float, l2: float, updates: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, labels = [], []
        for batch in batches:
            for index, value in zip(batch.column("index"), batch.column("value")):
                seen.append((np.frombuffer(index.as_py(), "<i4"), np.frombuffer(value.as_py(), "<f8")))
            labels += batch.column("label").to_pylist()
        z, n = np.zeros(1 << bits), np.zeros(1 << bits)

        def weights(i):
            shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - l1, 0)
            return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

        for _ in range(min(12, max(1, -(-updates // max(1, len(seen)))))):
            for (i, x), y in zip(seen, labels):
                w = weights(i)
                g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
                n[i] += g * g
        w = weights(np.arange(1 << bits)).astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], names=["weights"])

    return run


def train_quality(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = BITS,
    sample_rows: int = SAMPLE_ROWS,
    updates: int = UPDATES,
    alpha: float = 0.2,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> np.ndarray:
    """Weights learnt from ``labelled`` (id, label 0 or 1), of which a bounded sample is used.

    The sample is the ``sample_rows`` rows of smallest id hash: it is the same on every run. Texts become features where
    they are; one task gets those of the sample and learns from them in order. Rows
    without id, label or text are left out. Without any labelled row all weights are 0.
    """
    sample = labelled.select(F.col("id"), F.col("label").cast("double")).where("id is not null and label is not null")
    sample = sample.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    sample = stored(sample, "sample")
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id").withColumn("mark", F.xxhash64("text"))
    kind = texts.schema["id"].dataType.simpleString()
    made = texts.select("id", "text", "label", "mark").mapInArrow(_featured(bits), f"id {kind}, label double, mark long, index binary, value binary")
    ordered = made.repartition(1).sortWithinPartitions(F.xxhash64("id", F.lit(1)), "id", "mark")
    model = ordered.select("index", "value", "label").mapInArrow(_train(bits, alpha, beta, l1, l2, updates), "weights binary").first()
    return np.frombuffer(model[0], "<f4") if model else np.zeros(1 << bits, "<f4")


def _scores(weights: np.ndarray, batch: pa.RecordBatch, bits: int, column: str = "text") -> np.ndarray:
    dots = [weights[i] @ x for _, _, data, offsets in text_slices(batch, column) for i, x in features(data, offsets, bits)]
    return 1 / (1 + np.exp(-np.clip(np.array(dots, float), -30, 30)))


def _score(broadcast, bits: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = broadcast.value.astype(np.float64)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(_scores(weights, batch, bits))], names=["id", "score"])

    return run


def _accept(broadcast, bits: int, column: str):
    """Whole rows of a score of 0.5 or more; the slots of null texts are empty."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = broadcast.value.astype(np.float64)
        for batch in batches:
            yield batch.filter(pa.array(_scores(weights, batch, bits, column) >= 0.5, pa.bool_()))

    return run


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: 0 to 1, higher where label 1 is likelier. Null text counts as empty."""
    texts = id_and_text(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    bits = len(weights).bit_length() - 1
    broadcast = docs.sparkSession.sparkContext.broadcast(weights)
    return texts.mapInArrow(_score(broadcast, bits), f"id {kind}, score double").select(F.col("id").alias("doc_id"), "score")


def held_out(id_col: str):
    """The rows whose labels are not learnt from: crc32 of the id as text leaves 1 on division by 3."""
    return F.crc32(F.encode(F.coalesce(col(id_col).cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def _learnt(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str = "quality", **options) -> np.ndarray:
    learnt = labels.where(~held_out(id_col)).select(col(id_col).alias("id"), col(label_col).alias("label"))
    return train_quality(docs, learnt, id_col, text_col, **options)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Learns from the labels of rows that are not held out (a null id counts as the empty text there, and
    is never learnt from); only the text enters a score. Null and empty texts are scored by the bias
    alone. Repeated rows repeat their score; an empty table gives an empty result, and without labels
    every score is 0.5. Other columns are ignored.
    """
    weights = _learnt(docs, labels, id_col, text_col, label_col, **options)
    scored = score_quality(docs, weights, id_col, text_col)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least 0.5, each by its own text, with or without an id."""
    weights = _learnt(docs, labels, id_col, text_col, **options)
    broadcast = docs.sparkSession.sparkContext.broadcast(weights)
    return docs.mapInArrow(_accept(broadcast, len(weights).bit_length() - 1, text_col), docs.schema)
