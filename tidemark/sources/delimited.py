"""Delimited text as cells: quotes hold marks, doubled quotes and line ends, and the mark is told from the text itself."""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MARKS = ",;\t"
#: Characters of the text from which its mark is told.
HEAD = 4096
#: Bytes after which a decoder hands on what it has, and those that Python needs for a cell besides its characters.
BATCH_SIZE, CELL_BYTES = 8 << 20, 64
csv.field_size_limit(1 << 31 - 1)


def records(text: str, mark: str, spaced: bool = False) -> list[list[str]]:
    """The records of a text, those without any cell or with one blank cell left out.

    A quoted cell may hold marks, line ends and doubled quotes; an open quote reaches to the end of the text.
    """
    found = csv.reader(io.StringIO(text, newline=""), delimiter=mark, skipinitialspace=spaced)
    return [r for r in found if len(r) > 1 or (r and r[0].strip())]


def told_mark(text: str) -> tuple[str, bool]:
    """(mark, whether blanks after it are no part of a cell).

    The mark under which most records of the head have one number of cells, two or more, wins; of equals the one that makes
    more cells, then comma, semicolon, tab. A head that is cut loses its last record. Without any, the comma.
    """
    head = text[:HEAD]
    best = (0.0, 0, MARKS[0])
    for mark in MARKS:
        found = records(head, mark)
        found = found[:-1] if len(text) > HEAD and len(found) > 1 else found
        if found:
            cells, times = max(Counter(map(len, found)).items(), key=lambda x: (x[0] > 1, x[1], x[0]))
            if cells > 1 and (times / len(found), cells) > best[:2]:
                best = times / len(found), cells, mark
    mark = re.escape(best[2])
    bare = re.sub(r'"(?:[^"]|"")*"', '""', head)
    return best[2], bool(re.search(f"{mark} ", bare)) and not re.search(rf"{mark}[^ \r\n]", bare)


def cells_of(text: str | None, skip: int = 0) -> list[list[str]] | None:
    """The cells of a text after ``skip`` lines of preamble; a byte-order mark is no part of it."""
    if text is None:
        return None
    text = text.removeprefix("﻿")
    for _ in range(skip):
        line = re.search(r"\r\n|\r|\n", text)
        text = text[line.end() :] if line else ""
    return records(text, *told_mark(text))


def cells_size(cells: list[list[str]] | None) -> int:
    """About the bytes that cells take as Python lists."""
    return sum(CELL_BYTES * (1 + len(line)) + sum(map(len, line)) for line in cells or ())


def _decoded(skip: int):
    kind = pa.list_(pa.list_(pa.string()))

    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept, held = [], 0
        for texts in batches:
            for text in texts:
                kept.append(cells_of(text.as_py(), skip))
                held += cells_size(kept[-1])
                if held >= BATCH_SIZE:
                    yield pa.array(kept, kind)
                    kept, held = [], 0
            if kept:
                yield pa.array(kept, kind)
                kept, held = [], 0

    return decoded


def csv_cells(text: Column, skip: int = 0) -> Column:
    """Cells of delimited text as array<array<string>>; null for null, an empty array for a text without records.

    Cells leave a task in batches of some BATCH_SIZE bytes, since they take many times what their text does.
    """
    return F.arrow_udf(_decoded(skip), "array<array<string>>")(text)
