"""Token ids of texts, with a bounded memory of the ids of their words.

A byte-pair tokenizer splits text into words first and merges within each, so the ids of a text are
those of its words one after another, and a worker keeps the ids of words it has met. Texts of ASCII and
Latin letters, where no two Unicode tables differ, are split by array operations on classes of bytes; Arrow numbers their
distinct words, new ones are merged by the tokenizer's own model, and ids are put together by number. Of other
texts only the pieces of ASCII and Latin letters are split here; other pieces go to the library as they
are, and texts that white space might not part go to it whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

from tidemark.llm._common import FORGET

#: Bytes of words and ids that a worker remembers, in two generations, at about ``_ENTRY`` bytes beside each.
MEMORY_BYTES = 112 << 20
_ENTRY = 160
#: Characters of texts that are encoded together, and words of a longer text.
CHUNK_CHARS = 1 << 20
BLOCK_WORDS = 1 << 16
#: Words that the model merges at once.
GROUP_WORDS = 64
#: White space and joiners other than ASCII's own white space: texts with them are not parted.
_UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")

# The word patterns of byte-level tokenizers that name none, and of those that drop white space.
_BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACELESS_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Latin letters in one piece that every Unicode table since 5.0 has as such; the one left out becomes two characters in lower case.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_PLAIN = re.compile(f"[\x00-\x7f{_LATIN}]*")
#: The letters that stand for bytes in byte-level vocabularies: the byte itself if it is seen, else one from 256 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {byte: chr(256 + i) for i, byte in enumerate(b for b in range(256) if b not in _SEEN)}


def _spelt(word: bytes) -> str:
    """A word in the letters of a byte-level vocabulary."""
    if word.isascii() and (text := word.decode()).isprintable():  # of these only the space is not its own letter
        return text.replace(" ", _LETTERS[32])
    return word.decode("latin-1").translate(_LETTERS)


# Classes of bytes: the space, other white space, letters (all bytes beyond ASCII), digits, others.
_SPACE, _BLANK, _LETTER, _DIGIT, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x09:0x0E], _CLASS[0x20], _CLASS[0x30:0x3A], _CLASS[0x80:] = _BLANK, _SPACE, _DIGIT, _LETTER
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER


def word_starts(data: np.ndarray, offsets: np.ndarray, spaceless: bool) -> np.ndarray:
    """The first byte of every word of plain texts laid end to end. Words cover the texts; spaceless ones are parted by words of white space.

    As _BYTE_LEVEL_WORDS and _SPACELESS_WORDS say: a run of one class is a word, with the space before it if there is one;
    of other white space before it the last is a word of its own; an apostrophe that begins a word takes its ending along.
    """
    kind, first = _CLASS[data], np.zeros(len(data) + 4, bool)
    first[offsets] = True
    blank = kind <= _BLANK
    start = np.ones(len(data) + 4, bool)
    if spaceless:
        kind[blank] = _SPACE
        start[1 : len(data)] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | first[1 : len(data)]
    else:
        change = (kind[1:] != kind[:-1]) | first[1 : len(data)]
        taken = (kind[:-1] == _SPACE) & ~first[1 : len(data)]
        last = np.append(~blank[1:] & ~first[1 : len(data)], False)
        start[1 : len(data)] = np.where(blank[1:], ~blank[:-1] | first[1 : len(data)] | last[1:], change & ~taken)
    at = np.flatnonzero(data == 0x27)
    at = at[start[at]]
    if len(at):
        ahead = np.concatenate((data, np.zeros(4, np.uint8)))
        one, two = ahead[at + 1], ahead[at + 2]
        if spaceless:
            one, two = one | 0x20, two | 0x20
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & ~first[at + 1]
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~first[at + 1] & ~first[at + 2]
        ending = at + 1 + short + 2 * long
        start[at[short | long] + 1] = False
        start[ending[short | long]] = True
    return np.flatnonzero(start[: len(data)])


def _parts(words: str, spaceless: bool) -> re.Pattern:
    """Parts of a text: pieces that hold more than ASCII and Latin, with the white space before them, and words of the others."""
    for long, short in ((r"[\p{L}]", f"[A-Za-z{_LATIN}]"), (r"[\p{N}]", "[0-9]"), (r"\p{L}\p{N}", f"A-Za-z{_LATIN}0-9"), (r"\p{L}", f"[A-Za-z{_LATIN}]"), (r"\p{N}", "[0-9]")):
        words = words.replace(long, short)
    before = "" if spaceless else r"\s*+"
    return re.compile(rf"{before}[!-~\x00-\x08\x0e-\x1f\x7f{_LATIN}]*+[^\x00-\x7f{_LATIN}]\S*|" + (f"(?i:{words})" if spaceless else words), re.ASCII)


def _bytes_of(array: pa.BinaryArray) -> list[bytes]:
    _, ends, data = array.buffers()
    ends, data = np.frombuffer(ends, np.int32)[array.offset :][: len(array) + 1].tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Encoder:
    """encode(texts) gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memory_bytes: int = MEMORY_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.parting = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.parting.pre_tokenizer = Split(_LETTERS[0], "isolated")
        mark = self.model.encode(_LETTERS[0], add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lowers = bool(self.tokenizer.normalizer)
        self.generation = memory_bytes // 2
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        self.spaceless = False
        self.parts = self._pattern()

    def _pattern(self) -> re.Pattern | None:
        """What parts a text; None where the tokenizer's words do not come from a plain pattern."""
        spec = json.loads(self.tokenizer.to_str())
        if spec["normalizer"] and [n["type"] for n in spec["normalizer"].get("normalizers", ())] != ["NFC", "Replace", "Lowercase"]:
            return None
        steps = spec["pre_tokenizer"]
        steps = steps["pretokenizers"] if steps and steps["type"] == "Sequence" else [steps]
        last = steps[-1]
        if not last or last["type"] != "ByteLevel" or last["add_prefix_space"]:
            return None
        if len(steps) == 1 and last["use_regex"]:
            return _parts(_BYTE_LEVEL_WORDS, spaceless=False)
        one = steps[0]
        if len(steps) == 2 and not last["use_regex"] and one == {"type": "Split", "pattern": {"Regex": _SPACELESS_WORDS}, "behavior": "Removed", "invert": True}:
            self.spaceless = True
            return _parts(_SPACELESS_WORDS, spaceless=True)
        return None

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of single words of ASCII and Latin letters, by the model alone; white space of spaceless words has none.

        Words go to the model in groups, parted by the letter of the zero byte, whose id parts their ids again.
        """
        if self.spaceless:
            words = [b"" if w.isspace() else w.lower() if w.isascii() else w.decode().lower().encode() for w in words]
        spelt, out = list(map(_spelt, words)), []
        mark = _LETTERS[0]
        if self.mark is None or any(mark in w for w in spelt):
            return [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(spelt, add_special_tokens=False)]
        groups = [mark.join(spelt[i : i + GROUP_WORDS]) + mark for i in range(0, len(spelt), GROUP_WORDS)]
        for group in self.parting.encode_batch_fast(groups, add_special_tokens=False):
            ids = array("I", group.ids)
            data, begin = ids.tobytes(), 0
            for end in (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == self.mark)).tolist():
                out.append(data[begin:end])
                begin = end + 4
        return out

    def _whole(self, text: str) -> bool:
        """Whether a text must not be parted."""
        if self.parts is None or (not text.isascii() and _UNUSUAL.search(text)):
            return True
        lower = text.lower()
        return any(t in lower for t in self.added)

    def _learn(self, parts: set[bytes], plain: bool = False) -> None:
        """Puts the ids of the parts into the newer generation; ``plain`` ones are words of ASCII and Latin letters."""
        missing = parts.difference(self.known)
        new = missing.difference(self.older)
        words = list(new) if plain else [p for p in new if p.isascii() or _PLAIN.fullmatch(p.decode())]
        found = dict(zip(words, self._merged(words)))
        if len(words) < len(new):
            others = list(new.difference(found))
            found.update(zip(others, self._library([p.decode() for p in others])))
        if len(new) < len(missing):
            found.update((p, self.older[p]) for p in missing.difference(new))
        self.known.update(found)
        self.held += _ENTRY * len(found) + sum(map(len, found)) + sum(map(len, found.values()))

    def _age(self) -> None:
        if self.held > self.generation:
            self.older, self.known, self.held = self.known, {}, 0

    def _parted(self, parts: list[bytes]) -> bytes:
        self._learn(set(parts))
        ids = b"".join(map(self.known.__getitem__, parts))
        self._age()
        return ids

    def _long(self, text: str) -> bytes:
        out, parts = [], (m.group().encode() for m in self.parts.finditer(text))
        while block := list(islice(parts, BLOCK_WORDS)):
            out.append(self._parted(block))
        return b"".join(out)

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of short texts of ASCII and Latin letters."""
        spelt = [text.encode() for text in texts]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in spelt])))
        data = np.frombuffer(b"".join(spelt), np.uint8)
        if not len(data):
            return [b""] * len(texts)
        starts = word_starts(data, offsets, self.spaceless)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        number, distinct = words.indices.to_numpy(), _bytes_of(words.dictionary)
        self._learn(set(distinct), plain=True)
        of_word = list(map(self.known.__getitem__, distinct))
        self._age()
        size = np.fromiter(map(len, of_word), np.int64, len(of_word)) >> 2
        begin, ids = np.cumsum(size) - size, np.frombuffer(b"".join(of_word), "<u4")
        sizes = size[number]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        made = ids[np.repeat(begin[number] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        upto = 4 * ends[np.searchsorted(starts, offsets)]
        return [made[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for _, some in chunks(texts):
            whole = [self._whole(text) for text in some]
            plain = [not alone and len(text) <= CHUNK_CHARS and (text.isascii() or bool(_PLAIN.fullmatch(text))) for text, alone in zip(some, whole)]
            ids = iter(self._plain([text for text, easy in zip(some, plain) if easy]))
            for text, alone, easy in zip(some, whole, plain):
                if easy:
                    yield next(ids)
                elif alone:
                    yield self._library([text])[0]
                elif len(text) > CHUNK_CHARS:
                    yield self._long(text)
                else:
                    yield self._parted([p.encode() for p in self.parts.findall(text)])


@functools.cache
def encoder(path: str, memory_bytes: int = MEMORY_BYTES) -> Encoder:
    """One encoder a worker process and file."""
    return Encoder(path, memory_bytes)


FORGET.append(encoder.cache_clear)


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first, rows) of runs of texts of about ``most`` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def text_chunks(column: pa.Array, most: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about ``most`` bytes: no more than one run of a batch is held as strings."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, first = np.cumsum(sizes), 0
    while first < len(column):
        done = int(upto[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + most, "right")))
        yield first, column.slice(first, last - first).to_pylist()
        first = last
