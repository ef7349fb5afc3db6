"""Vectorised hashing of words and byte strings. All arithmetic is modulo 2**64."""

from __future__ import annotations

import secrets

import numpy as np

U = np.uint64
#: An odd base, its inverse modulo 2**64, and an odd multiplier for sequences of hashes.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = 0xD1342543DE82EF95
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(-(-max(n, 1) // (1 << 16)) << 16, base, U)
        table[0] = 1
        np.cumprod(table, out=table)
        _powers[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble, so that every bit of the result depends on every bit of the input."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial hash of the first i bytes."""
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * _power_table(BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each bytes[start:end], whatever its place."""
    return mix((sums[end] - sums[start]) * _power_table(INVERSE, len(sums))[start] + (end - start).astype(U) * U(STEP))


_PRIME = U((1 << 31) - 1)


def _powers_mod(base: int, n: int) -> np.ndarray:
    """base**i modulo the prime for i below n."""
    table, factor = np.ones(1, U), base
    while len(table) < n:
        table = np.concatenate((table, table * U(factor) % _PRIME))
        factor = factor * factor % int(_PRIME)
    return table[:n]


def secret_bases() -> tuple[int, int]:
    """Bases for keyed_spans, drawn anew for each run."""
    return tuple(secrets.randbelow(int(_PRIME) - 2) + 2 for _ in range(2))


def keyed_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bases: tuple[int, int]) -> np.ndarray:
    """Hash of each bytes[start:end], of two polynomials modulo a prime: without the bases nobody can build a collision."""
    out = (ends - starts).astype(U) * U(STEP)
    for base in bases:
        sums = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * _powers_mod(base, len(data)) % _PRIME, out=sums[1:])
        back = _powers_mod(pow(base, -1, int(_PRIME)), len(data) + 1)
        out = (out << U(31)) + (out >> U(33)) + (sums[ends] - sums[starts]) % _PRIME * back[starts] % _PRIME
    return mix(out)


def is_word_byte(*ranges: tuple[int, int], inside: bool) -> np.ndarray:
    """A table over bytes: those in the ranges are word bytes (or, with inside=False, are not)."""
    table = np.full(256, not inside)
    for a, b in ranges:
        table[a : b + 1] = inside
    return table


def words_of(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of all words in texts laid end to end; text i has words first[i] to first[i+1]."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = word_byte[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets[:-1]] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | begins[:n]))
    ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive elements."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for j in range(k):
        out = out * U(STEP) + hashes[j : j + n]
    return mix(out + U(k))
