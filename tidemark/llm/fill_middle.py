"""Fill-in-middle examples, cut at tokens that an event scan by one Aho-Corasick automaton counts.

A token is a run of ASCII letters, or any other single code point. One automaton reads the classes of the code points and
finds where letters begin, where they end, and the three marks. Between two such events all code points are of
one class: a gap of letters is one token, any other gap as many as it is long. So the events
of a block, and the tokens before it, are all that is needed to find where the u-th token ends.

Texts are scanned in blocks, of which only the token counts are kept; the blocks that hold a cut are scanned again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import col, trimmed

#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points that are scanned at once, and characters of a batch of results.
BLOCK_CHARS, BATCH_CHARS = 1 << 16, 1 << 22
#: Classes of code points: letters that no mark holds, those that marks hold, what stands around them, all others.
_LETTERS, _OTHERS = "aPSM", "<>."
_BEGIN, _END, _MARK = 0, 1, 2


@functools.cache
def _classes() -> np.ndarray:
    """The class of each ASCII character, and last that of all other code points."""
    table = np.full(129, ord("."), np.uint8)
    for first in (ord("A"), ord("a")):
        table[first : first + 26] = ord("a")
    for c in "PSM<>":
        table[ord(c)] = ord(c)
    return table


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """Finds changes of class and marks. A value is the kind of event; a change is told at its second character."""
    found = ahocorasick.Automaton()
    for letter in _LETTERS:
        for other in _OTHERS:
            found.add_word(other + letter, _BEGIN)
            found.add_word(letter + other, _END)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        found.add_word(mark, _MARK)
    found.make_automaton()
    return found


def events(text: str) -> tuple[np.ndarray, bool, bool]:
    """(places where the class changes, whether the first code point is a letter, whether a mark occurs)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _classes()[np.minimum(points, 128)].tobytes().decode("ascii")
    found = np.fromiter((3 * i + kind for i, kind in automaton().iter(classes)), np.int64)
    kinds = found % 3
    return found[kinds != _MARK] // 3, bool(classes) and classes[0] in _LETTERS, bool((kinds == _MARK).any())


class TokenRanks:
    """The tokens of one text: how many there are, whether a mark occurs, and where the u-th ends.

    Blocks overlap by two code points, so that events at their borders are seen.
    """

    def __init__(self, text: str, block_chars: int = BLOCK_CHARS):
        self.text, self.size, self.marked = text, block_chars, False
        self.before = [0]
        for first in range(0, len(text), block_chars):
            _, units, marked = self._gaps(first)
            self.marked |= marked
            self.before.append(self.before[-1] + int(units.sum()))
        self.n = self.before[-1]

    def _gaps(self, first: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """(ends, tokens) of the gaps of a block, and whether a mark ends in it. A run that came in from before counts as no token."""
        back = min(first, 2)
        last = min(first + self.size, len(self.text))
        changes, letter, marked = events(self.text[first - back : last])
        changes = changes - back
        # the class at the block's first code point is that of the first one seen, turned by each change up to there
        early = int(np.searchsorted(changes, 0, "right"))
        letter ^= bool(early % 2)
        goes_on = letter and back > 0 and not (early and changes[early - 1] == 0)
        ends = np.append(changes[early:], last - first)
        units = np.diff(ends, prepend=0)
        units[0 if letter else 1 :: 2] = 1
        if goes_on:
            units[0] = 0
        return ends + first, units, marked

    def end(self, rank: int) -> int:
        """The code points up to the end of the ``rank``-th token; 0 for none."""
        if rank <= 0:
            return 0
        block = int(np.searchsorted(self.before, rank, "left")) - 1
        ends, units, _ = self._gaps(block * self.size)
        upto = self.before[block] + np.cumsum(units)
        gap = int(np.searchsorted(upto, rank, "left"))
        place = int(ends[gap])
        if not self.text[place - 1].isascii() or not self.text[place - 1].isalpha():
            return place - int(upto[gap] - rank)
        while gap == len(ends) - 1 and place < len(self.text):  # a run may go on through any number of blocks
            ends, units, _ = self._gaps(place)
            gap = 0
            if units[0]:
                break
            place = int(ends[0])
        return place


def example(text: str, h: tuple[int, int, int, int], plain_from: int, spm_below: int, block_chars: int = BLOCK_CHARS) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, code points of the prefix, of the middle, output); h are the four draws."""
    ranks = TokenRanks(text, block_chars)
    n = ranks.n
    if not text or ranks.marked or h[2] % 100 >= plain_from:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = ranks.end(first), ranks.end(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_below:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def _examples(schema: pa.Schema, plain_from: int, spm_below: int, block_chars: int) -> Callable:
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            draws = zip(*(batch.column(f"h{i}").to_pylist() for i in range(1, 5)))
            for name, text, h in zip(batch.column("id"), batch.column("text"), draws):
                text = text.as_py()
                rows.append((name, *example(text, h, plain_from, spm_below, block_chars)))
                size += len(text) + 64
                if size >= BATCH_CHARS:
                    yield _batch(rows, schema)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    names = pa.array([name.as_py() for name in columns[0]], schema.field(0).type)
    return pa.RecordBatch.from_arrays([names, *(pa.array(c, f.type) for c, f in zip(columns[1:], list(schema)[1:]))], schema=schema)


def _draws(name: Column, seed: str) -> list[Column]:
    """Four numbers below 2**32 from the digest of ``seed:name``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    plain_from: int = 90,
    spm_below: int = 20,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` is the count of tokens. The form is ``plain``, the text itself, where the text is empty or holds a mark and for
    draws of ``plain_from`` in a hundred or more; else ``psm`` or, below ``spm_below`` in a hundred, ``spm``. Draws
    come from the digest of the seed and the id, so rows that repeat their id are cut by the same draws,
    and rows without an id by those of an empty one. Null text counts as empty. Cuts may meet, and parts may be empty.
    prefix_chars and middle_chars are null for plain rows. Other columns are ignored; an empty table gives an
    empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", "text", *_draws(F.col("id"), seed))
    result = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    schema = pa.schema(
        [("doc_id", _arrow_type(docs, id_col)), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())]
    )
    return rows.mapInArrow(_examples(schema, plain_from, spm_below, block_chars), result)


def _arrow_type(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of fill_in_middle was made from."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of fill_in_middle."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
