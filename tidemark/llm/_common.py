"""What the operators share: the shared folder, written tables, size-checked joins and Arrow text access."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared_files import qualified, shared_folder

#: Rows of 8-byte keys that may be broadcast (about 40 MB as a hash table); beyond it joins shuffle.
BROADCAST_ROWS = 500_000
#: Rows that one key may bring to a task of a join before they are spread, and keys that may be spread that way.
HOT_ROWS, HOT_KEYS = 1000, 100_000
#: Bytes of text that a numpy kernel works on at once.
SLICE_BYTES = 1 << 18


def scratch(spark: SparkSession, name: str) -> str:
    """A qualified path in this application's part of the shared folder that nothing else uses."""
    return f"{qualified(spark, shared_folder(spark))}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: lineage ends here."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just (id, text), null text as empty: no other column can clash with what operators add."""
    return df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))


def only_ids(df: DataFrame, key: str, ids: DataFrame, how: str = "left_semi", bound: int = BROADCAST_ROWS) -> DataFrame:
    """Semi or anti join with a written table of distinct keys: broadcast below a checked count, shuffled beyond it."""
    ids = ids.select(F.col(ids.columns[0]).alias(key))
    small = len(ids.head(1)) == 0 or ids.count() <= bound
    return df.join(F.broadcast(ids) if small else ids, key, how)


#: What frees the memory that a worker keeps from task to task.
FORGET: list[Callable[[], None]] = []


def trimmed(run: Callable, remembers: bool = False) -> Callable:
    """A task's function that gives freed memory back to the system when it is done: workers live on between tasks.

    Unless it ``remembers``, what tasks of other kinds have kept in the worker goes first.
    """

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not remembers:
            for forget in FORGET:
                forget()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


remembering = functools.partial(trimmed, remembers=True)


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """Inner join with a written table of one row a key, whose column ``rows`` says how many rows of ``left`` have it.

    Keys of very many rows are joined by a broadcast, wherever their rows lie. No more than HOT_KEYS keys can
    each have more than the HOT_KEYS-th part of all rows, which bounds it.
    """
    most = max(HOT_ROWS, (right.agg(F.sum(rows)).first()[0] or 0) // HOT_KEYS)
    hot, rest = right.where(F.col(rows) > most), right.where(F.col(rows) <= most)
    if hot.isEmpty():
        return left.join(right, keys)
    return left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys).unionByName(left.join(F.broadcast(hot), keys))


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets into them) of consecutive row ranges.

    A range has ``most`` bytes, or one longer text: memory follows the longest text, not the batch.
    """
    array = batch.column(column)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    rows = len(array)
    if not rows:
        return
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        last = min(last, rows)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last
